"""Helpers hold Python objects for a piece of a batch, not for all of it."""

import random
import tracemalloc

import pyarrow as pa
import pytest

from boardlake.functions import batches, search, texts
from boardlake.operators import headers
from boardlake.sources import framing, html_posts, mysql_dump


def of_texts(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["n", "text"])


def test_pieces_are_the_rows_in_order_and_small():
    batch = of_texts(["x" * (k % 7 * 100) for k in range(5000)] + ["y" * 5_000_000] + [None, ""])
    pieces = list(batches.in_pieces(batch, 1 << 16))
    assert pa.Table.from_batches(pieces).combine_chunks().equals(pa.Table.from_batches([batch]).combine_chunks())
    assert all(p.nbytes <= 1 << 16 or p.num_rows == 1 for p in pieces)
    assert [p.num_rows for p in batches.in_pieces(of_texts([]))] == [0]
    assert batches.mapped(lambda n, t: None if t is None else n + len(t), pa.int64(), *batch.columns).to_pylist()[-4:] == [4999 + 4999 % 7 * 100, 5_005_000, None, 5002]


def test_terms_are_inverted_in_pieces():
    tokens = [[f"w{k * j % 977}" for j in range(400)] for k in range(3000)]
    n = len(tokens)
    batch = pa.RecordBatch.from_arrays([pa.array(["s"] * n), pa.array(["b"] * n), pa.array(range(n)), pa.array(tokens)], names=["site", "board", "post_no", "tokens"])
    out = list(search._invert(iter([batch])))
    assert len(out) > 4 and max(b.nbytes for b in out) < batch.nbytes / 2
    rows = {(r["post_no"], r["term"]): r["positions"] for b in out for r in b.to_pylist()}
    assert len(rows) == sum(b.num_rows for b in out) == sum(len(set(t)) for t in tokens)
    assert all(rows[k, f"w{k * 3 % 977}"][0] <= 4 for k in range(n)) and rows[0, "w0"] == list(range(1, 401))


def test_a_frequent_word_is_stemmed_once_for_a_worker(monkeypatch):
    seen = []
    monkeypatch.setattr(search, "stem", lambda w: seen.append(w) or w[:3])
    search.english.cache_clear()
    tokens = pa.array([["walking", "the", "walking"], [], None, ["dogs", None]]).slice(0)
    assert [search.stems_of(t).to_pylist() for t in (tokens, tokens.slice(1))] == [want := [["wal", None, "wal"], [], None, ["dog", None]], want[1:]]
    assert sorted(seen) == ["dogs", "walking"]
    search.english.cache_clear()


def test_a_text_of_null_has_no_tokens(spark):
    rows = spark.createDataFrame([(1, "The walking dogs"), (2, None), (3, "")], "n int, text string")
    got = {r.n: r.tokens for r in rows.select("n", search.tokens_english(rows.text).alias("tokens")).collect()}
    assert got == {1: [None, "walk", "dog"], 2: None, 3: []}


def most_traced(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("html, read", [
    ('<div class="postContainer" id="pc7"><blockquote class="postMessage">{}</blockquote></div>', lambda page, _: html_posts.native(html_posts.page_of(page))),
    ('<div class="post"><span class="post_no">7</span><div class="post_com">{}</div></div>', lambda page, thread: html_posts.legacy(html_posts.page_of(page), thread)),
])
def test_pages_are_read_in_pieces(html, read):
    n = 3000
    columns = [pa.array([str(k) for k in range(n)]), pa.array(["b"] * n), pa.array([None] * n, pa.int64()), pa.array([html.format("x" * 3000)] * (n - 1) + [None])]
    out = []
    assert most_traced(lambda: out.extend(html_posts._found(iter([pa.RecordBatch.from_arrays(columns, names=["file", "board", "thread", "page"])]), read))) < 6_000_000
    assert [r["posts"][0]["no"] if r["posts"] else None for b in out for r in b.to_pylist()] == ["7"] * (n - 1) + [None]


def test_splits_are_read_in_pieces():
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * 4000), pa.array([0] * 1500 + [9] * 2500), pa.array([b"x" * 5000] * 4000)], names=["file", "block", "value"])
    seen = []
    assert most_traced(lambda: seen.extend((key, sum(map(len, values))) for key, values in framing.by_split(iter([batch])))) < 6_000_000
    assert seen == [(("f", 0), 7_500_000), (("f", 9), 12_500_000)]


def test_results_of_a_batch_are_made_in_pieces():
    texts = pa.array([f"({k}, '{'x' * 3000}')" for k in range(4000)])
    got = []
    assert most_traced(lambda: got.append(batches.mapped(mysql_dump.tuples_of, mysql_dump.ARROW_ROW, texts))) < 8_000_000
    assert len(got[0]) == 4000 and got[0][3999].as_py() == [["3999", "x" * 3000]]


def test_labels_are_assigned_in_one_sorted_pass(spark):
    rng = random.Random(5)
    text = lambda: f"0{rng.randint(1, 3)}/1{rng.randint(0, 3)}/0{rng.randint(1, 9)}(Mon)1{rng.randint(0, 9)}:22No.{rng.randint(10, 40)}"
    labels = spark.createDataFrame([(f"i{k}", n, text()) for k in range(60) for n in range(rng.randint(1, 7))], "image string, label_no int, label string")
    lines = spark.createDataFrame([(f"i{k}", n, text()) for k in range(60) for n in range(rng.randint(0, 7))], "image string, line_no int, line string")
    near, want = {}, set()
    for r in headers.near_pairs(lines, labels).collect():
        near.setdefault(r.image, []).append((r.distance, r.label_no, r.line_no))
    for image, pairs in near.items():
        used = set()
        for d, label, line in sorted(pairs):
            if not used & {("label", label), ("line", line)}:
                used |= {("label", label), ("line", line)}
                want.add((image, label, line, d))
    got = headers.assign(lines, labels)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want) > 100
    assert headers.least_distance("ab1x", "ab2") == 1 and headers.least_distance("", "a") is None and headers.least_distance("x", "") == 1
    assert "InPandas" not in got._jdf.queryExecution().toString()  # which calls Python for each image


def test_distances_of_texts_longer_than_the_steps_between_cuts():
    rng = random.Random(6)
    for n, m in [(63, 64), (64, 129), (200, 65), (300, 310)]:
        a, b = ("".join(rng.choice("abc") for _ in range(k)) for k in (n, m))
        row = list(range(m + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i] + [0] * m
            for j, y in enumerate(b, 1):
                row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
        assert texts.edit_distance(a, b) == row[m]
