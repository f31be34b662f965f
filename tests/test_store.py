"""The store, the streams that feed one, ties of first writers, histograms and headers, against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from boardlake.functions import search
from boardlake.operators import dedup, headers, histogram
from boardlake.plans.store import PostStore
from boardlake.sources import json_posts
from boardlake.streaming import summary

POST = "source_id int, site string, board string, thread_no long, post_no long, is_op boolean, ts_utc long, subject string, body_text string"
DAY = 86400


def post(n, board="g", ts=0, body="x", source=1, site="s"):
    return (source, site, board, 1, n, n == 1, ts, None, body)


@pytest.fixture
def store(spark):
    rows = [post(1, ts=DAY * 400, body="the red fox"), post(2, ts=None, body="red foxes"), post(3, board="h", ts=DAY * 800), post(1, site="other")]
    return PostStore(spark.createDataFrame(rows, POST)).refresh_stats()


def test_ingest(spark, store):
    offers = spark.createDataFrame([(*post(2, body="later"), 2, 0), (*post(4, ts=DAY * 400, source=2), 2, 0), (*post(4, ts=DAY * 400, source=3), 3, 0), (*post(5), 2, 1)], POST + ", source_rank int, subnum int")
    new = store.ingest(offers)
    assert sorted((r.site, r.post_no, r.body_text, r.source_id) for r in new.posts.collect()) == sorted([("s", 1, "the red fox", 1), ("s", 2, "red foxes", 1), ("s", 3, "x", 1), ("other", 1, "x", 1), ("s", 4, "x", 2)])
    assert {tuple(r) for r in new.stats.collect()} == {tuple(r) for r in new.refresh_stats().stats.collect()}
    again = new.ingest(offers)
    assert again.posts.count() == 5 and sum(r.posts for r in again.stats.collect()) == 5


def test_commands(store):
    assert [(r.bucket, r.posts) for r in store.count("red fox", by="year").collect()] == [("1971", 1), (None, 1)]
    assert [r.post_no for r in store.search("red foxes").collect()] == [1, 2]
    assert [r.post_no for r in store.search("red foxes", config=search.SIMPLE, limit=5).collect()] == [2]
    with pytest.raises(ValueError):
        store.search("x", limit=0)
    assert {(r.site, r.board, r.posts) for r in store.list_boards().collect()} == {("s", "g", 2), ("s", "h", 1), ("other", "g", 1)}
    assert {r.site for r in store.list_sites().collect()} == {"s", "other"}
    survey = store.survey("year", boards=["g"], distinct=True, per_board=True)
    assert {(r.site, r.posts) for r in survey["boards"].collect()} == {("s", 2), ("other", 1)}
    assert {r.bucket: r.posts for r in survey["buckets"].collect()} == {"1970": 1, "1971": 1, "(undated)": 1, "TOTAL": 3}
    assert {r.distinct_posts for r in survey["distinct"].collect()} == {1, 2}
    assert survey["board_buckets"].count() == 3


def test_ties_go_to_the_row_that_was_read_first(spark):
    rows = [("s", "g", 1, 1, f, n, b) for f, n, b in (("b", 1, "late"), ("a", 9, "third"), ("a", 2, "first"))] + [("s", "g", 1, 2, "a", 1, "other archive")]
    offers = spark.createDataFrame(rows * 3, "site string, board string, post_no long, source_rank int, file string, row long, body_text string")
    for parts in (1, 5):
        assert [r.body_text for r in dedup.first_writer(offers.repartition(parts)).collect()] == ["first"]
    plain = offers.drop("file", "row")
    assert len({dedup.first_writer(plain.orderBy(F.rand(k)).repartition(4)).first().body_text for k in range(4)}) == 1


def test_threads_of_other_sites(spark):
    threads = spark.createDataFrame([(1, "g", 5, "a"), (2, "g", 6, "b"), (3, "g", 0, "a")], "thread_ref long, board string, thread_no long, site string")
    posts = spark.createDataFrame([(i, r) for i, r in enumerate([1, 1, 2, 3, 4, None])], "post_no long, thread_ref long")
    assert tuple(dedup.thread_audit(posts, threads, "a").first()) == (2, 1, 3)


def test_adaptive_width(spark):
    r = random.Random(3)
    rows = [("a", r.randrange(10**6)) for _ in range(400)] + [("b", 5)] * 9 + [("c", 65535), ("c", 65536)] + [("d", -r.randrange(2**31)) for _ in range(300)]
    posts = spark.createDataFrame([(s, t) for s, t in rows] + [("e", None)], "s string, ts_utc long")
    got = {x.s: x.width for x in histogram.adaptive_width(posts, 20, series=["s"]).collect()}
    want = {s: next(2**k for k in range(33) if len({t >> k for x, t in rows if x == s}) <= 40) for s in "abcd"}
    assert got == want


def test_streams(spark, tmp_path):
    source, lines = tmp_path / "in", defaultdict(list)
    source.mkdir()
    for k, numbers in enumerate([(1, 2, 2), (2, 3), (3, 4, 1)]):
        lines[k] = [f'{{"board":"g","num":{n},"thread_num":1,"timestamp":{DAY * n if n != 4 else "null"},"comment":"{k}"}}' for n in numbers]
    for k in range(3):
        (source / f"{k}.ndjson").write_text("\n".join(lines[k]))
        stream = json_posts.stored(json_posts.staged_posts(spark.readStream.schema("value string").text(str(source)).withColumnRenamed("value", "line"))).withColumn("source_id", F.lit(4))
        for start, name in ((summary.keep_posts, "posts"), (lambda *a: summary.keep_buckets(*a, DAY), "buckets")):
            start(stream, str(tmp_path / name), str(tmp_path / f"{name}-ck")).awaitTermination(120)
    assert sorted((r.post_no, r.body_text) for r in summary.read_posts(spark, str(tmp_path / "posts")).collect()) == [(1, "0"), (2, "0"), (3, "1"), (4, "2")]
    assert sorted((r.bucket, r.posts) for r in summary.read_buckets(spark, str(tmp_path / "buckets"), DAY).collect()) == [(1, 2), (2, 3), (3, 2)]
    assert sorted((r.bucket, r.posts) for r in summary.read_buckets(spark, str(tmp_path / "buckets"), DAY, 2 * DAY).collect()) == [(0, 2), (1, 5)]


def test_staged_lines_round_trip(spark, tmp_path, store):
    json_posts.stage(store.posts, str(tmp_path / "out"))
    back = json_posts.stored(json_posts.read_staged_folders(spark, str(tmp_path / "out")))
    fields = ("site", "board", "thread_no", "post_no", "is_op", "ts_utc", "body_text")
    assert {tuple(r) for r in back.select(*fields).collect()} == {tuple(r) for r in store.posts.select(*fields).collect()}


HEADERS = [
    ("Anonymous 04/12/07(Thu)23:43:59 No. 24400000", (24400000, "04/12/07(Thu)23:43:59")),
    ("x 04/12/07(Thu)2343.59UTC-4No.123", (123, "04/12/07(Thu)23:43:59")),
    ("04/12/07(Fni)23;43N0.5", (5, "04/12/07(Thu)23:43")),
    ("04/12/07()2343No012", (12, "04/12/07(Thu)23:43")),
    ("04/12/07(Fri)23:43:59 No.1", None), ("02/31/07(Thu)23:43 No.1", None), ("04/12/07(Thu)24:00 No.1", None), ("04/12/07(Thu)23:4 No.1", None), ("no header", None), (None, None),
]


def test_headers(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(HEADERS)], "i int, line string")
    got = {r.i: tuple(r.h) if r.h else None for r in rows.select("i", headers.read_header(F.col("line")).alias("h")).collect()}
    assert got == dict(enumerate(want for _, want in HEADERS))
    shapes = spark.createDataFrame([("O4/l2/07 xx Na.12",), ("04/12/07 nothing",), ("No.12 04/12/07",), ("1204563816.jpg No.12",)], "line string")
    assert [r[0] for r in shapes.select(headers.looks_like_header(F.col("line"))).collect()] == [True, False, False, False]


def test_scores_of_headers(spark):
    labels = spark.createDataFrame([("a.png", 0, "b", 12, "04/12/07(Thu)23:43", "04/12/07(Thu)23:43No.12"), ("a.png", 1, "b", 13, "04/12/07(Thu)23:44", "04/12/07(Thu)23:44No.13"), ("b.png", 0, "b", 9, "01/01/08(Tue)01:01", "01/01/08(Tue)01:01No.9")], "image string, label_no int, board string, post_no long, date string, label string")
    lines = spark.createDataFrame([("a.png", 0, "X 04/12/07(Thu)23:44 No.13"), ("a.png", 1, "X 04/12/07(Fri)23:43 No.12"), ("a.png", 2, "04/12/07(Thu)11:11No.7777777"), ("b.png", 0, "noise")], "image string, line_no int, line string")
    per = {r.image: tuple(r)[1:] for r in headers.score(lines, labels).collect()}
    assert per == {"a.png": (2, 2, 1, 1, 2), "b.png": (1, 0, 0, 0, 0)}
    total = headers.score_totals(headers.score(lines, labels)).first()
    assert (total.labels, total.found, total.exact, total.wrong, total.found_pct, total.wrong_pct) == (3, 2, 1, 1, 66.7, 50.0)
