"""What the methods promise beyond the small fixture: robust estimates, deep splits, shards, models on unseen words, odd inputs."""

import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardlake.llm import bpe, common, html_text, neardup, quality, repeats, secrets, token_shards, toxicity, url_filter

rng = random.Random(12)
NAMES = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(900)]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n, r=rng):
    return " ".join(r.choice(NAMES) for _ in range(n))


def shared(spark, name):
    base = common.shared_dir(spark)
    return f"{base if '://' in base else 'file://' + base}/{name}"


def test_key_filter(spark):
    keys = spark.range(3000).select((F.col("id") * 7).alias("k"))
    rows = spark.range(30000).withColumnRenamed("id", "k")
    for most in (1 << 10, 1 << 20):
        got = {r.k for r in common.KeyFilter(common.written(keys, "test-keys"), ["k"], most).candidates(rows).collect()}
        assert {k * 7 for k in range(3000)} & set(range(30000)) <= got
        assert len(got) < 12000
    assert common.KeyFilter(common.written(keys.limit(0), "test-keys"), ["k"]).candidates(rows).isEmpty()


def test_written_tables_are_deleted(spark):
    first, second, third = (common.written(spark.range(n), "test-table") for n in (1, 2, 3))
    common.discard(first)
    common.discard_others(third)
    assert third.count() == 3 and common._WRITTEN == [third]
    for gone in (first, second):
        with pytest.raises(Exception, match="(?i)not.exist|FILE_NOT_EXIST"):
            spark.read.parquet(gone._table_path).count()


# ---- quality rules


def mcd(x, prior_mean, prior_cov, weight, starts=20, seed=1):
    """Plain numpy: the mixed scatter of the nearest 75 % with the least determinant from many random starts, then reweighted."""
    r, best = np.random.default_rng(seed), None
    own = lambda n: n / (n + weight)

    def mixed(rows, factor):
        a = own(len(rows))
        return a * rows.mean(0) + (1 - a) * prior_mean, a * factor * np.cov(rows.T, bias=True) + (1 - a) * prior_cov

    far = lambda m, s: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
    for _ in range(starts):
        m, s = mixed(x[r.choice(len(x), max(len(x) // 4, 1), replace=False)], 1.0)
        for _ in range(30):
            d = far(m, s)
            m, s = mixed(x[d <= np.quantile(d, quality.SHARE)], quality.FACTOR)
        det = np.linalg.slogdet(s)[1]
        if best is None or det < best[0]:
            best = det, m, s
    m, s = mixed(x[far(*best[1:]) <= quality.INNER], quality.INNER_FACTOR)
    return best[0], m, s, far(m, s)


def quality_rows():
    r, rows = random.Random(8), []
    for lang, source, n, long in (("en", "a", 400, 1), ("en", "b", 150, 3), ("de", "a", 300, 1), ("de", "tiny", 3, 1), (None, None, 80, 1)):
        for k in range(n):
            text = prose(r.randint(60 * long, 240 * long), r)
            if k % 10 == 3:
                text = " ".join(w + r.choice(["###", "$$%", "|<>"]) for w in text.split())
            elif r.random() < 0.2:
                text += " # & *"
            rows.append((len(rows), text, lang, source, 0))
    return rows


def test_estimates_against_numpy(spark):
    rows = quality_rows()
    stats = common.written(quality.statistics(spark.createDataFrame(rows, DOCS).repartition(5)).drop("text"), "test-stats")
    kept = {r.doc_id: (r.kept, r.distance) for r in quality.apply_mcd(stats, quality.fit_mcd(stats)).collect()}
    data = stats.select("doc_id", "_lang", "_source", *quality.X).toPandas()
    right, far = 0, []
    for lang, part in data.groupby("_lang"):
        x = part[quality.X].to_numpy()
        median = np.median(x, 0)
        spread = np.diag((1.4826 * np.median(np.abs(x - median), 0)) ** 2)
        _, m, s, _ = mcd(x, median, spread, quality.LANGUAGE_PRIOR)
        for _, own in part.groupby("_source"):
            _, _, _, d = mcd(own[quality.X].to_numpy(), m, s, quality.PRIOR)
            for i, v in zip(own["doc_id"], d, strict=True):
                right += (v <= quality.CUTOFF) == kept[i][0]
                if v < quality.CUTOFF:
                    far.append(abs(kept[i][1] - v) / (1 + v))
    assert right >= 0.99 * len(rows), right
    assert np.median(far) < 0.1
    odd = {r[0] for r in rows if re.search("###|[$][$]%|[|]<>", r[1])}
    assert not any(kept[i][0] for i in odd)
    assert sum(v[0] for i, v in kept.items() if i not in odd) >= 0.97 * (len(rows) - len(odd))


def test_a_small_source_is_judged_by_its_language(spark):
    r = random.Random(3)
    rows = [(i, prose(r.randint(60, 240), r), "en", "big", 0) for i in range(300)]
    rows += [(1000, " ".join(w + "#$#$" for w in prose(90, r).split()), "en", "one", 0), (1001, prose(100, r), "en", "two", 0), (1002, "#### " * 40 + prose(40, r), "xx", "only", 0)]
    kept = {x.doc_id: x.kept for x in quality.judge_quality(spark.createDataFrame(rows, DOCS)).collect()}
    assert not kept[1000] and kept[1001]


# ---- n-gram Jaccard join


def test_deep_splits_and_blocks(spark, monkeypatch):
    for name, value in (("SMALL", 4), ("BLOCK", 8), ("BLOCK_GRAMS", 1500), ("DEPTH", 4)):
        monkeypatch.setattr(neardup, name, value)
    r = random.Random(2)
    base = prose(100, r).split()
    texts = [prose(60, r) for _ in range(40)]
    for _ in range(120):  # some hundred sets that share most of their shingles
        w = list(base)
        for _ in range(r.choice((0, 1, 1, 2, 3))):
            w[r.randrange(len(w))] = r.choice(NAMES)
        texts.append(" ".join(w))
    sets = [frozenset(neardup.gram_set(t).tolist()) for t in texts]
    link = lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b)
    want = {i: sum(link(a, b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)}
    got = {x.doc_id: x.n_links for x in neardup.link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)).collect()}
    assert got == want
    assert max(want.values()) > 40


def test_runs():
    assert neardup.runs_for(0.9999, 1) == 10 and neardup.runs_for(0.9999, 3) == 20
    assert neardup.runs_for(0.9, 1) < neardup.runs_for(0.9, 2)


# ---- suffix-array dedup


@pytest.mark.parametrize("letters", ["ab", "a", "abcdefghij"])
def test_suffix_array(letters):
    r = random.Random(len(letters))
    base = "".join(r.choice(letters) for _ in range(500)).encode()
    pieces = [base[(o := r.randrange(150)) : o + r.randrange(200, 340)] for _ in range(20)] + ["".join(r.choice(letters) for _ in range(250)).encode() for _ in range(10)]
    at, seen = [], {}
    for k, p in enumerate(pieces):
        for o in range(len(p) - repeats.SPAN + 1):
            seen.setdefault(p[o : o + repeats.SPAN], []).append(sum(map(len, pieces[:k])) + o)
    for v in seen.values():
        at += v if len(v) > 1 else []
    left = np.concatenate([np.arange(len(p), 0, -1) for p in pieces])
    assert sorted(repeats.suffix_classes(np.frombuffer(b"".join(pieces), np.uint8), left).tolist()) == sorted(at)


# ---- secret scan


def test_weak_parts_against_brute_force(spark):
    r = random.Random(4)
    parts = ["user=alice", "https://db.example.com/x", "Ab1" * 9, "token: secret99", "AKIA" + "Z" * 20, "0123456789abcdef" * 2]
    texts = ["".join(r.choice(parts) + " " + "x " * r.randrange(0, 320) for _ in range(r.randint(1, 9))) for _ in range(150)]
    base = len(secrets.BASE)
    role = lambda k: 0 if secrets.KINDS[k] in ("assign", "hex", "weak") else 2 if secrets.KINDS[k] == "endpoint" else 1
    want = {}
    for i, t in enumerate(texts):
        found = secrets.find(t, list(range(len(secrets.KINDS))))
        near = lambda s, k: any(abs(s - u) <= secrets.SCOPE and (role(j) == 0) != (role(k) == 0) for u, j, _ in found)  # noqa: E731, B023
        want[i] = sorted((s, k, e) for s, k, e in found if k < base or near(s, k))
    got = {x.doc_id: [(p["start"], p["kind"], p["end"]) for p in x.found] for x in secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    # parts in one bin of SCOPE, or in neighbouring bins and at most SCOPE apart, are in scope
    assert got == want
    assert any(len(v) < len(secrets.find(texts[i], list(range(len(secrets.KINDS))))) for i, v in want.items())


# ---- token shards


def test_documents_slots_and_ids(spark, tmp_path):
    rows = [(i if i % 9 else None, prose(rng.randint(0, 90)) if i % 7 else None, "x", 1) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, slot string, shard int").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    folder = shared(spark, "tokens-brute")
    out = token_shards.materialise(docs, folder, length=32, shard=16).collect()
    path = token_shards.vocabulary()
    read = list(token_shards.read_slots(folder, 0, len(out), 32, 16))
    assert sorted(x.slot for x in out) == list(range(len(out))) and len(read) == len(out)
    texts = {}
    for x in out:  # put the sequences of each document together again, by its chunks
        texts.setdefault((x.doc_id, x.slot if x.doc_id is None else None), {})[x.chunk] = read[x.slot].tolist()
        assert zlib.crc32(read[x.slot].tobytes()) == x.ids_crc32 and x.shard == x.slot // 16
    for i, t, *_ in rows:
        if i is not None:
            ids = token_shards.ids_of(t, path).tolist()
            assert [v for k in sorted(texts[i, None]) for v in texts[i, None][k]] == ids
    flat = sorted(tuple(token_shards.ids_of(t, path)[k : k + 32].tolist()) for _, t, *_ in rows for k in range(0, len(token_shards.ids_of(t, path)), 32))
    assert sorted(tuple(x.tolist()) for x in read) == flat
    # the numbers before the permutation are those of the input's order
    order = token_shards.permute(np.arange(len(out)), len(out))
    slots = {s: n for n, s in enumerate(order.tolist())}
    by_number = sorted(out, key=lambda x: slots[x.slot])
    chunks = [x.chunk for x in by_number]
    assert all(b == 0 or b == a + 1 for a, b in zip([-1, *chunks], chunks, strict=False))
    assert [x.slot for x in by_number] != sorted(x.slot for x in by_number)


def test_shards_of_other_inputs(spark):
    created = spark.createDataFrame([(i, prose(20)) for i in range(40)], "doc_id long, text string")
    out = token_shards.materialise(created, shared(spark, "tokens-created"), length=16, shard=8).collect()
    assert sorted(x.slot for x in out) == list(range(len(out))) and {x.doc_id for x in out} == set(range(40))
    joined = created.join(created.select("doc_id"), "doc_id")
    assert token_shards.materialise(joined, shared(spark, "tokens-joined"), length=16, shard=8).count() == len(out)
    assert token_shards.materialise(created.limit(0), shared(spark, "tokens-empty")).count() == 0


def test_a_split_that_was_not_counted_is_an_error():
    import pyarrow as pa

    run = token_shards.cut(token_shards.vocabulary(), 8, 100, 1, 4)
    batch = lambda first, expected: iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["a b"], "file": ["f"], "block": [0], "first": pa.array([first], pa.int64()), "expected": pa.array([expected], pa.int64())})])
    assert sum(b.num_rows for b in run(batch(0, 1))) == 1
    for first, expected in ((0, 2), (None, None)):
        with pytest.raises(ValueError):
            list(run(batch(first, expected)))


# ---- HTML extraction

#: Pages written by hand, with the article's blocks.
PAGES = [
    ("""<!DOCTYPE html><html lang=en><head><meta charset=utf-8><title>River returns</title><style>p{color:red}</style></head><body>
<div id="site-header"><a href="/">The Valley Paper</a><ul class="main-nav"><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li><li><a href="/w">Weather</a></li></ul></div>
<article><h1>River returns to its old bed</h1><p>After three years of work the river was let back into the bed that it had left a century ago, and the first fish were seen on Monday.</p>
<p>&ldquo;We did not expect it so soon,&rdquo; said the engineer, who had waited at the weir since dawn with <a href="/team">her whole team</a> and a flask of tea.</p></article>
<div class="related"><h3>More stories</h3><ul><li><a href="/1">Bridge closed</a></li><li><a href="/2">Market moved</a></li></ul></div>
<footer><p>© 2020 The Valley Paper. All rights reserved.</p></footer></body></html>""",
     ["River returns to its old bed", "After three years of work the river was let back into the bed that it had left a century ago, and the first fish were seen on Monday.", "“We did not expect it so soon,” said the engineer, who had waited at the weir since dawn with her whole team and a flask of tea."]),
    ("""<html><body><nav><a href=/>Home</a> <a href=/blog>Blog</a></nav><main><h1>Baking rye bread</h1><p>Feed the starter in the evening and leave it in a warm corner of the kitchen until it has doubled.<p>In the morning mix it with the flour,
the salt and as much water as the dough will take.<ul><li>500 g of rye flour, coarsely ground</li><li>10 g of salt from the sea</li></ul></main>
<section id="comments"><h2>Comments</h2><div class="comment"><b>Jo</b><p>Mine came out flat, what did I do wrong with it?</p></div></section>
<aside class="sidebar"><form class="search"><input name=q><button>Search</button></form></aside><script>var a="<p>no</p>";</script></body></html>""",
     ["Baking rye bread", "Feed the starter in the evening and leave it in a warm corner of the kitchen until it has doubled.", "In the morning mix it with the flour, the salt and as much water as the dough will take.", "500 g of rye flour, coarsely ground", "10 g of salt from the sea"]),
    ("""<html><body><div class="cookie-notice"><p>We use cookies to make this site work. Do you agree?</p><button>Yes</button></div><div class="banner ad">Buy one lamp and get a second lamp for free today</div>
<div class="post-content"><h2>How clocks were kept in step</h2><p>Before there were wires each town kept its own noon, and travellers set their watches at every stop along the line.</p><blockquote><p>The train is on time, it is the town that is late.</p></blockquote>
<p>When the railways came, one time had to do for all of them, and the church clocks followed slowly.</p></div><div class="footer"><p>Imprint and contact</p></div></body></html>""",
     ["How clocks were kept in step", "Before there were wires each town kept its own noon, and travellers set their watches at every stop along the line.", "The train is on time, it is the town that is late.", "When the railways came, one time had to do for all of them, and the church clocks followed slowly."]),
]


def test_pages_written_by_hand():
    model = html_text.fit(*html_text.labelled_pages())
    assert html_text.extract([p for p, _ in PAGES], *model) == ["\n".join(blocks) for _, blocks in PAGES]


@pytest.mark.parametrize("page", ["<b>" * 20000 + "</i>" * 20000, "<i><div>" + "<b>" * 20000 + "</i>" * 20000, "<b>" * 20000 + "<option></option>" * 5000, "<div>" * 20000 + "x", '<a ">' * 20000, "<p>" + "<b>" * 20000 + "</b></p>" * 1000])
def test_pages_are_read_in_linear_time(page):
    model = np.zeros(html_text.N_FEATURES), np.zeros((html_text.EDGE_KINDS, 2, 2))
    html_text.extract(["<p>x"], *model)
    began = time.time()
    html_text.extract([page], *model)
    assert time.time() - began < 3


# ---- models on what they were not trained with


def test_unseen_spellings_of_hosts():
    model = url_filter.fit(url_filter.labelled_urls())
    known = {h for h, _, _ in url_filter.labelled_urls()}
    bad = ["freecasinos.org", "replicas24.com", "buypillz.com", "casinoz-bonusses.net", "viagras.net", "jackpotts-win.org", "spamfarms.com", "cheappillsnow.com", "lotterywinners.org", "xxxescorts.com"]
    good = ["gardens-of-x.org", "libraries.net", "my-museums.org", "schoolteachers.com", "travelling.net", "historic-bridges.org", "musical-review.com", "weathers.net", "townarchives.org", "sciences.com"]
    assert not known & set(bad + good)
    score = url_filter.probability(bad + good, ["/en/1"] * 20, *model)
    assert sum(score[:10] >= 0.5) >= 9 and sum(score[10:] < 0.5) >= 9
    assert model[1] != 0 and url_filter.probability([""], [""], *model)[0] < 0.5


def test_labels_that_are_learnt_from(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "b"), (1, "aa"), (1, "bb"), (2, "x" * 100), (3, "y"), (4, None), (None, "n")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (3, 1), (4, 0), (9, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    rows, shares = toxicity.labelled_rows(docs, labels, F.lit(True))
    assert [(r.doc_id, r.toxic, r.text) for r in rows] == [(1, 1, "b"), (2, 0, "x" * 100), (4, 0, "")]
    assert shares == {0: 2, 1: 2}
    monkeypatch.setattr(toxicity, "TRAIN_BYTES", 50)
    assert 2 not in {r.doc_id for r in toxicity.labelled_rows(docs, labels, F.lit(True))[0]}


# ---- columns with clashing names, empty tables, a column type of its own


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(i, prose(60), "a", 1, "b", True, b"z") for i in range(6)], "doc_id long, text string, _k string, starts int, score string, held_out boolean, z binary")
    assert repeats.remove_repeats(docs).count() == 6
    pages = spark.createDataFrame([(1, "http://a.net/x", "<body><article><h1>" + prose(4) + "</h1><p>" + prose(40) + "</p></article>", "t", 5, "h", "v")], "page_id long, url string, html string, text string, n_chars int, host string, verdict string")
    text = html_text.extract_main_text(pages)
    assert text.columns == pages.columns and text.first().n_chars == len(text.first().text) > 40
    judged = url_filter.judge_urls(pages).first()
    assert (judged.host, judged.verdict, judged.text) == ("a.net", "block", "t")
    labels = spark.createDataFrame([(i, i % 2, "x", 1) for i in range(6)], "doc_id long, toxic int, text string, score int")
    assert toxicity.score_toxicity(docs, labels, F.lit(False)).columns == ["doc_id", "held_out", "score", "predicted"]
    assert html_text.extract_main_text(pages.limit(0)).count() == url_filter.judge_urls(pages.limit(0)).count() == 0


def test_encoding_and_decoding_columns(spark):
    rows = spark.createDataFrame([(1, "Hello  World"), (2, None), (3, "")], "i int, text string")
    out = {r.i: (list(r.ids), r.back) for r in rows.withColumn("ids", bpe.encode_column(F.col("text"))).withColumn("back", bpe.decode_column(F.col("ids"))).collect()}
    assert out[2] == out[3] == ([], "") and out[1][1] == "hello</w> world</w>" and len(out[1][0]) == 2


@pytest.mark.parametrize("text", ["a" * 1_000_000 + " http://x", "a@" * 300_000, "token" + " " * 500_000, "a.b@c-" * 150_000 + ":22"])
def test_secrets_of_long_runs_take_linear_time(text):
    began = time.time()
    secrets.find(text, list(range(len(secrets.KINDS))))
    assert time.time() - began < 5


def test_large_leaves_and_kinds_of_sets(spark, monkeypatch):
    for name, value in (("BLOCK", 16), ("BLOCK_SETS", 50), ("BLOCK_GRAMS", 3000), ("SMALL", 16)):
        monkeypatch.setattr(neardup, name, value)
    r = random.Random(21)
    long, nine = prose(40, r), prose(8, r)
    texts = [f"{long} own{i}" for i in range(90)] + [f"{nine} own{i}" for i in range(90)] + [f"{long} own{i % 3} and {prose(r.randint(0, 9), r)}" for i in range(60)] + [prose(30, r) for _ in range(30)]
    texts += texts[:5] * 4 + texts[100:103]
    sets = [set(neardup.gram_set(t).tolist()) for t in texts]
    like = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    want = {i: (sum(like(s, u) for u in sets) - 1, len({frozenset(u) for u in sets if u != s and like(s, u)})) for i, s in enumerate(sets)}
    got = neardup.link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {x.doc_id: (x.n_links, x.n_text_links) for x in got} == want


# ---- what the driver has to hold of many shuffle partitions


def test_estimates_of_many_groups_are_written_in_few_files(spark, monkeypatch):
    files = {}

    def counted(df, name, written=common.written):
        out = written(df, name)
        files.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(quality, "written", counted)
    many = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    r = random.Random(5)
    docs = spark.createDataFrame([(i, prose(r.randint(20, 60), r), f"l{i % 30}", f"s{i % 60}", 0) for i in range(240)], DOCS)
    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        assert quality.judge_quality(docs).filter("kept").count() > 200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {"mcd-medians", "mcd-frame", "mcd-start", "mcd-step", "mcd-final"} <= set(files)
    assert max(n for name, counts in files.items() if name != "mcd-rows" for n in counts) <= 8, files


def test_large_leaves_of_all_levels_and_runs_are_done_once(spark, monkeypatch):
    for name, value in (("BLOCK", 16), ("SMALL", 16)):
        monkeypatch.setattr(neardup, name, value)
    calls = []
    monkeypatch.setattr(neardup, "star_edges", lambda sets, f=neardup.star_edges: calls.append(1) or f(sets))
    r = random.Random(22)
    long = prose(40, r)
    texts = [f"{long} own{i}" for i in range(60)] + [prose(30, r) for _ in range(20)]
    got = neardup.link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {x.doc_id: x.n_links for x in got} == {i: 59 if i < 60 else 0 for i in range(80)}
    assert len(calls) == 1
