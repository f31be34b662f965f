import pytest
from pyspark.sql import functions as F

from boardlake.sources import json_posts, mysql_dump
from boardlake.streaming import summary


def test_tuples():
    text = r"(1, 'a),(b', NULL), (2,'it''s \'x\' \n\\',-3.5),(3,'',0)"
    assert mysql_dump.tuples_of(text) == [["1", "a),(b", None], ["2", "it's 'x' \n\\", "-3.5"], ["3", "", "0"]]
    for broken in ("(1, 'open)", "(1, 2"):
        with pytest.raises(ValueError):
            mysql_dump.tuples_of(broken)


LINES = [
    '{"num":"1","thread_num":"0","timestamp":"5","comment":"a b"}',
    '{"num":2,"thread_num":1,"timestamp":86400,"comment":"x\\u0000y","site":"other"}\r',
    '{"num":3,"thread_num":1,"subnum":1}',
    "not json",
    '{"num":2,"thread_num":1,"timestamp":7}',
]


def test_staged_lines(spark, tmp_path):
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "posts.ndjson").write_text("\n".join(LINES) + "\n", newline="")
    posts = json_posts.read_staged(spark, str(tmp_path)).cache()
    assert tuple(json_posts.counters(posts).first()) == (5, 1, 1)
    got = json_posts.stored(posts).orderBy("post_no", "ts_utc").select("site", "board", "thread_no", "post_no", "is_op", "body_text").collect()
    assert [tuple(r) for r in got] == [("site0", "g", 1, 1, True, "a b"), ("site0", "g", 1, 2, False, None), ("other", "g", 1, 2, False, "xy")]


def test_summary_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [f'{{"board":"g","num":{n},"thread_num":1,"timestamp":{n}}}' for n in (1, 2, 3)]
    for k in range(2):
        (tmp_path / "in" / f"{k}.ndjson").write_text("\n".join(lines[: k + 2]))
        query = summary.keep_stats(summary.staged_stream(spark, str(tmp_path / "in"), 4), str(tmp_path / "out"), str(tmp_path / "ck"))
        query.awaitTermination(60)
    total = summary.read_stats(spark, str(tmp_path / "out")).agg(F.sum("posts")).first()[0]
    assert total == 3


def test_json_files_by_path(spark, tmp_path):
    api = '{"posts":[{"no":5,"resto":0,"time":9,"com":"a<br>b","filename":"f","ext":".png"},{"no":6,"resto":5}]}'
    for name in ("g/5.json", "g/g 5.txt", "g/5/5.json", "g/notes.json"):
        (tmp_path / "api" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "api" / name).write_text(api)
    rows = json_posts.read_api_threads(spark, str(tmp_path / "api")).collect()
    assert len(rows) == 6 and {(r.board, r.thread_no, r.post_no, r.is_op) for r in rows} == {("g", 5, 5, True), ("g", 5, 6, False)}
    scraped = '{"Thread":{"Posts":[{"OriginalObject":{"num":"7","thread_num":"8","timestamp":"3","deleted":"1"}}]}}'
    for folder in ("x/a/g/7", "x/a/g/9", "x/b/h/7"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "thread.json").write_text(scraped)
    rows = json_posts.read_scraped(spark, str(tmp_path / "x")).collect()
    assert {(r.board, r.thread_no, r.is_op, r.deleted, r.mismatch) for r in rows} == {("g", 7, True, True, True), ("g", 9, False, True, True), ("h", 7, True, True, True)}
    assert {(r.root.rsplit("/", 1)[1], r.threads) for r in json_posts.scraped_roots(spark, str(tmp_path / "x")).collect()} == {("a", 2), ("b", 1)}
    (tmp_path / "e.ndjson").write_text('{"num":"1","thread_num":"1","timestamp":"5","comment":"","board":{"shortname":"g"},"media":null}\n{"num":"x"}\n')
    rows = json_posts.stored(json_posts.read_exported(spark, str(tmp_path / "e.ndjson"))).collect()
    assert [(r.board, r.post_no, r.body_text) for r in rows] == [("g", 1, None)]
