"""The committed store: runs that stop anywhere, the order of its sources, its indexes, and the plan of its key store."""

import random

import pytest
from pyspark.sql import functions as F

from boardlake.functions import search
from boardlake.operators import aggregates, filters
from boardlake.plans.archive import Archive
from boardlake.plans.commits import Commits
from boardlake.plans.key_store import KeyStore

POST = "source_id int, site string, board string, thread_no long, post_no long, is_op boolean, ts_utc long, subject string, body_text string, subnum int"
LOCK = ["first", "second", "third"]


def offers(spark):
    r = random.Random(2)
    words = "red fox stone house with the".split()
    rows = {n: [(k, "s", r.choice("gh"), 1, r.randrange(40), False, r.choice([None, 86400 * 400 * r.randrange(4)]), None, f"{n} " + " ".join(r.choice(words) for _ in range(4)), int(r.random() < 0.1)) for _ in range(60)] for k, n in enumerate(LOCK)}
    return lambda name: spark.createDataFrame(rows[name], POST).repartition(2)


def content(archive, config=search.SIMPLE):
    store = archive.store(config)
    posts = sorted(str(tuple(x)) for x in store.posts.collect())
    index = sorted((x.term, x.board, x.post_no, tuple(x.positions)) for x in store.index.read().collect()) if store.index else None
    return posts, sorted(str(tuple(x)) for x in store.stats.collect()), index


class Stopped(Exception):
    pass


def test_runs_that_stop_anywhere_give_the_same_store(spark, tmp_path, monkeypatch):
    whole = Archive(spark, str(tmp_path / "whole"), buckets=4)
    assert whole.store() is None and whole.sync(LOCK, offers(spark)) == LOCK
    want, left, stops = content(whole), [0], 0
    first = {}
    for name in LOCK:
        for r in offers(spark)(name).collect():
            if not r.subnum:
                first.setdefault((r.board, r.post_no), name)
    assert sorted((p.board, p.post_no, p.body_text.split()[0]) for p in whole.store().posts.collect()) == sorted((*k, n) for k, n in first.items())
    assert want[1] == sorted(str(tuple(x)) for x in aggregates.post_stats(whole.store().posts).collect())

    def stop(*_):
        left[0] -= 1
        if left[0] == 0:
            raise Stopped

    archive = Archive(spark, str(tmp_path / "other"), buckets=4)
    with monkeypatch.context() as m:
        m.setattr(Archive, "_written", stop)
        for place in (1, 2, 3, 4, 5, 6, 7, 8):  # each place of a source once, over all sources
            left[0] = place
            try:
                archive.sync(LOCK, offers(spark))
            except Stopped:
                stops += 1
                if archive.sources():
                    assert archive.store().posts.count() == sum(x.posts for x in archive.store().stats.collect())
    assert stops >= 5
    with monkeypatch.context() as m:
        m.setattr(Commits, "commit", stop)
        left[0] = 1
        if archive.sources() != LOCK:
            with pytest.raises(Stopped):
                archive.sync(LOCK, offers(spark))
    archive.sync(LOCK, offers(spark))
    assert content(archive) == want
    assert archive.sync(LOCK, offers(spark)) == [] and content(archive) == want


def test_order_of_sources_and_indexes(spark, tmp_path):
    archive = Archive(spark, str(tmp_path / "a"), indexes=("simple", "english"), buckets=4)
    archive.sync(LOCK[:2], offers(spark))
    for lock in (["second", "first"], ["first"], []):
        with pytest.raises(ValueError):
            archive.sync(lock, offers(spark))
    archive.drop_indexes(only="english")
    assert archive.store(search.ENGLISH).index is None
    assert archive.sync(LOCK, offers(spark)) == ["third"]
    for config in (search.SIMPLE, search.ENGLISH):
        store = archive.store(config)
        got = {(x.board, x.post_no) for x in store.where("stones:* & !red" if config.name == "simple" else "stones & !red", config).collect()}
        want = filters.by_condition(store.posts, "stones:* & !red" if config.name == "simple" else "stones & !red", config)
        assert got == {(x.board, x.post_no) for x in want.collect()}
    before = content(archive, search.ENGLISH)
    archive.build_indexes(only="english")
    assert content(archive, search.ENGLISH) == before
    assert {x["name"] for x in archive.index_status().collect()} == {"simple", "english"}


def test_two_writers(spark, tmp_path):
    commits = Commits(spark, str(tmp_path / "c"))
    commits.commit({"a": 1}, 0)
    with pytest.raises(RuntimeError):
        commits.commit({"a": 2}, 0)
    assert commits.latest() == (1, {"a": 1})


def test_store_of_keys_is_not_shuffled(spark, tmp_path):
    rows = spark.range(500).selectExpr("concat('s', id % 2) as site", "concat('b', id % 3) as board", "id as post_no")
    keys = KeyStore(spark, str(tmp_path / "k"), 8)
    for part in range(3):
        keys.put(rows.filter(f"post_no % 5 = {part}"), part)
    keys.put(rows.filter("post_no % 5 = 2"), 2)
    assert sorted(x.post_no % 5 for x in keys.absent(rows, F.col("part") < 2).select("post_no").collect()) == sorted([2, 3, 4] * 100)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = keys.absent(rows, F.col("part") < 2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan and plan.count("Exchange hashpartitioning") == 1
