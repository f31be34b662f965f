"""The training-data operators against brute force, on a fixture with copies, near copies, nulls, ties and long texts."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from boardlake.llm import bpe, decontaminate, html_text, neardup, quality, repeats, secrets, token_shards, toxicity, url_filter
from boardlake.llm.common import shared_dir

rng = random.Random(4)
NAMES = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(900)]


def prose(n, r=rng):
    return " ".join(r.choice(NAMES) for _ in range(n))


PASSAGE = prose(70)
LONG = prose(6000)
BASE = [prose(rng.randint(20, 160)) for _ in range(60)]
TEXTS = [None, "", " \n\t ", "x", "ä" * 300, "ab" * 400, *BASE, BASE[3], BASE[3], BASE[5] + " tail", *[f"{t} {PASSAGE} {prose(5)}" for t in BASE[:6]], LONG, LONG[:5000] + prose(30), "same line here\n" * 6 + prose(40), "AKIA" + "Q" * 20 + " password = hunter2222", "user=alice\nhttps://db.example.com/x\n" + "Ab1" * 9, "token: 'abcdef0123456789abcdef0123456789'"]
ROWS = [(i, t, "en", f"s{i % 2}", len(t or "")) for i, t in enumerate(TEXTS)]
ROWS += [(None, BASE[0], None, None, None), (7, TEXTS[7], "en", "s1", 1)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = SCHEMA + ", kept boolean, _k string, found string, score double"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('docs')}/documents.parquet"
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_repeats(docs, empty):
    got = repeats.repeated_starts(docs)
    rows = got[0].join(got[1], ["_k", "_h"], "left").select("doc_id", "z", "starts").mapInArrow(repeats.finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").collect()
    data = [(r[0], (r[1] or "").encode()) for r in ROWS]
    seen = Counter(b[k : k + 200] for _, b in data for k in range(len(b) - 199))
    want = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if seen[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want.append((i, len(b), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest()))
    same([tuple(r) for r in rows], want)
    assert repeats.remove_repeats(empty).count() == 0


def test_quality(docs, empty):
    out = quality.judge_quality(docs).collect()
    word = re.compile(r"[^\x20\x09-\x0D]+")
    want = []
    for i, t, *_ in ROWS:
        w = word.findall(t or "")
        lines = [x for x in (t or "").split("\n") if word.search(x)]
        c = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        cover = {k + j for k in range(len(w) - 4) if c[tuple(w[k : k + 5])] > 1 for j in range(5)}
        want.append((i, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(lines) - len(set(lines)), len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)))
    same([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out], want)
    assert not any(r.kept for r in out if r.base_failed)
    assert quality.judge_quality(empty).count() == 0


def test_quality_finds_planted_outliers(spark):
    r = random.Random(8)
    clean = [(i, prose(r.randint(60, 240), r), "en", "s", 0) for i in range(400)]
    odd = [(1000 + i, " ".join(w + "###$$$%%%" for w in prose(100, r).split()), "en", "s", 0) for i in range(40)]
    out = {x.doc_id: x.kept for x in quality.judge_quality(spark.createDataFrame(clean + odd, SCHEMA)).collect()}
    assert not any(out[1000 + i] for i in range(40))
    assert sum(out[i] for i in range(400)) >= 392


def linked_by_brute_force():
    sets = {}
    for i, (key, t, *_) in enumerate(ROWS):
        sets[i] = key, frozenset(neardup.gram_set(t).tolist())
    link = lambda a, b: a == b or bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)
    label = list(range(len(sets)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    n = [0] * len(sets)
    for i in range(len(sets)):
        for j in range(len(sets)):
            if i != j and link(sets[i][1], sets[j][1]):
                n[i] += 1
                a, b = sorted((root(i), root(j)))
                label[b] = a
    groups = {}
    for i in range(len(sets)):
        groups.setdefault(root(i), []).append(sets[i][0])
    least = {g: min((k for k in v if k is not None), default=None) for g, v in groups.items()}
    return [(sets[i][0], least[root(i)], n[i]) for i in range(len(sets))], len(groups)


def test_jaccard_join(docs, empty):
    want, n_groups = linked_by_brute_force()
    same([(r.doc_id, r.class_id, r.n_links) for r in neardup.link_documents(docs).collect()], want)
    assert neardup.keep_one(docs).count() == n_groups
    assert neardup.link_documents(empty).count() == 0


def test_bpe(docs, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.vocabulary())
    library.no_padding(), library.no_truncation()
    extra = ["<|endoftext|> Naïve CAFÉ", "İstanbul ΣΑΣ 東京 🙂 \u0000 é", "don't we'll 12345 !!! a_b"]
    spark = docs.sparkSession
    more = spark.createDataFrame([(900 + i, t) for i, t in enumerate(extra)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    want = []
    for i, t in [(r[0], r[1]) for r in ROWS] + [(900 + i, t) for i, t in enumerate(extra)]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    same([tuple(r) for r in bpe.encode_digests(every).collect()], want)
    assert bpe.encode_digests(empty).count() == 0


def test_secrets(docs, empty):
    got = secrets.find_secrets(docs).collect()
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = []
    for i, t, *_ in ROWS:
        t = t or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6] + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))
        want.append((i, hashlib.sha256(base.encode()).hexdigest()))
    same([(r.doc_id, r.base_sha256) for r in got], want)
    linked = next(r for r in got if r.doc_id == len(TEXTS) - 2)
    assert {secrets.KINDS[p["kind"]] for p in linked.found} == {"ident", "weak", "endpoint"}
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(docs).collect()}
    assert "hunter2222" not in masked[len(TEXTS) - 3] and masked[6] == TEXTS[6]
    assert secrets.find_secrets(empty).count() == 0


def test_a_weak_part_alone_is_no_finding(spark):
    far = "user=alice " + "x " * 500 + "Ab1" * 9
    rows = spark.createDataFrame([(1, "Ab1" * 9), (2, far), (3, "user=alice"), (4, "user=alice " + "Ab1" * 9)], "doc_id long, text string")
    assert {r.doc_id: len(r.found) for r in secrets.find_secrets(rows).collect()} == {1: 0, 2: 0, 3: 0, 4: 2}


def test_decontamination(spark, docs, empty):
    items = [(1, PASSAGE), (2, prose(30)), (3, None), (4, "few words"), (5, " ".join(LONG.split()[100:120]).upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def grams(t):
        w = re.sub(r"[!-/:-@\[-`{-~]", " ", (t or "").lower()).split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    want = []
    for i, t, *_ in ROWS:
        for item, b in items:
            g = grams(b)
            if g and len(g & grams(t)) >= 0.8 * len(g) - 1e-9:
                want.append((i, item, len(g & grams(t)), len(g)))
    assert want
    same([(r.doc_id, r.item_id, r.n_shared, r.n_shingles) for r in decontaminate.find_items(docs, bench).collect()], want)
    assert decontaminate.find_items(empty, bench).count() == 0
    kept = [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()]
    assert sorted(map(str, kept)) == sorted(str(r[0]) for r in ROWS if r[0] not in {w[0] for w in want})


def test_html(spark):
    pages, labels = html_text.labelled_pages(60, seed=99)
    trees = [html_text.parse(p) for p in pages]
    import numpy as np

    want = [html_text.assemble(t, np.array(y, bool)) for t, y in zip(trees, labels, strict=True)]
    odd = [None, "", "plain", "<p>a<p>b &amp; c<script>x</script>", "<div" * 2000, "<div>" * 2000 + "deep"]
    rows = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages + odd)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract_main_text(rows).collect()}
    right = sum(got[i] == w for i, w in enumerate(want))
    assert right >= 51, right
    assert got[60] == got[61] == ""
    assert all(isinstance(got[60 + k], str) for k in range(len(odd)))


def test_toxicity_on_held_out_rows(spark):
    from pyspark.sql import functions as F

    r = random.Random(2)
    bad = ["grumblefoot", "snarkwhistle", "blathernap"]

    def text(toxic):
        words = prose(40, r).split()
        if toxic:
            w = r.choice(bad)
            k = r.randrange(2, len(w) - 2)
            words[10:10] = [w[:k] + r.choice("abcde") + w[k:]] * 3
        return " ".join(words)

    rows = [(i, text(i % 3 == 0), i % 3 == 0) for i in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, None), (5001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows] + [(None, 1), (7, None)], "doc_id long, toxic int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    out = {x.doc_id: x for x in toxicity.score_toxicity(docs, labels, held).collect()}
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in out)
    mine = [(out[i].score, y) for i, _, y in rows if out[i].held_out]
    pos, neg = [s for s, y in mine if y], [s for s, y in mine if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert auc > 0.9, auc
    assert 0 <= out[5000].score <= 1 and out[5000].score == out[5001].score
    assert toxicity.score_toxicity(docs.limit(0), labels, held).count() == 0


def test_urls(spark):
    urls = ["http://a.net/x?y", "https://www.Example.NET/en/9", "http://example.com/de/1#z", "http://x.org/fr/2", "http://anet/", None, "", "no scheme", "http://cheap-pills.example.org/buy", "http://nice-garden.org/en/guide", "ftp://net"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(rows).collect()}
    assert got[0] == ("a.net", "/x", "net/", "block")
    assert got[1] == ("www.example.net", "/en/9", "example.net/en/", "allow")
    assert got[2] == ("example.com", "/de/1", "example.com/de/", "block")
    assert got[3] == ("x.org", "/fr/2", "org/fr/", "allow")
    assert got[4][2] is None and got[8][3] == "block" and got[9][3] == "allow"
    assert got[5] == got[6] == got[7] and got[5][:3] == ("", "", None)
    assert got[10][:3] == ("net", "", None)
    hosts, paths, label = zip(*url_filter.labelled_urls(400, seed=123), strict=True)
    score = url_filter.probability(list(hosts), list(paths), *url_filter.fit(url_filter.labelled_urls()))
    assert sum((s >= 0.5) == y for s, y in zip(score, label, strict=True)) >= 340


def test_token_shards(spark, docs):
    base = shared_dir(spark)
    folder = f"{base if '://' in base else 'file://' + base}/tokens-test"
    out = token_shards.materialise(docs, folder, length=64, shard=32).collect()
    n = len(out)
    assert sorted(r.slot for r in out) == list(range(n))
    ids = list(token_shards.read_slots(folder, 0, n, 64, 32))
    by = sorted(out, key=lambda r: r.slot)
    assert [len(x) for x in ids] == [r.n_tokens for r in by]
    assert [zlib.crc32(x.tobytes()) for x in ids] == [r.ids_crc32 for r in by]
    path = token_shards.vocabulary()
    total = sum(len(token_shards.ids_of(r[1], path)) for r in ROWS)
    assert sum(map(len, ids)) == total
    assert [x.tolist() for x in token_shards.read_slots(folder, 20, 30, 64, 32)] == [x.tolist() for x in ids[20:50]]


def test_columns_with_clashing_names(spark):
    rows = [(i, t, "en", "s", 1, True, "a", "b", 0.5) for i, t in enumerate(BASE[:12])]
    docs = spark.createDataFrame(rows, EXTRA)
    bench = spark.createDataFrame([(1, BASE[2])], "item_id long, text string")
    assert quality.judge_quality(docs).count() == 12
    assert neardup.keep_one(docs).columns == docs.columns
    masked = secrets.mask_secrets(docs)
    assert masked.columns == docs.columns and {(r._k, r.found) for r in masked.collect()} == {("a", "b")}
    assert {r._k for r in neardup.keep_one(docs).collect()} == {"a"}
    assert decontaminate.drop_contaminated(docs, bench).count() == 11
    assert bpe.encode_digests(docs).count() == 12
