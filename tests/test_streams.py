"""Streams: adaptive histograms after any cut into batches, and the split by date with its counts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardlake.operators import histogram
from boardlake.streaming import histogram as adaptive
from boardlake.streaming import summary

FIELDS = "source_id int, site string, board string, post_no long, ts_utc long"


def stream_of(spark, folder, batches):
    folder.mkdir()
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, FIELDS).coalesce(1).write.parquet(str(folder / f"{k}.parquet"))
    return spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).parquet(str(folder / "*.parquet"))


@pytest.mark.parametrize("cut", [1, 3])
def test_adaptive_histogram_of_a_stream(spark, tmp_path, cut):
    r = random.Random(cut)
    rows = [(1, "s", b, r.randrange(10**6), r.choice([None, r.randrange(low, high)])) for b, low, high, n in (("a", 0, 10**9, 400), ("b", -(10**6), 10**6, 200), ("c", 5, 6, 30), ("d", 0, 40, 60)) for _ in range(n)]
    r.shuffle(rows)
    stream = stream_of(spark, tmp_path / "in", [rows[k::cut] for k in range(cut)])
    adaptive.keep_adaptive(stream, str(tmp_path / "out"), str(tmp_path / "ck"), 20).awaitTermination(180)
    got = adaptive.read_adaptive(spark, str(tmp_path / "out"), 20)
    want = histogram.adaptive(spark.createDataFrame(rows, FIELDS), 20)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    states = spark.read.parquet(str(tmp_path / "out")).groupBy("batch", "board", "salt").count().agg(F.max("count")).first()[0]
    assert states <= 40


def test_states_merge_in_any_order():
    r = np.random.default_rng(1)
    at = r.integers(-(10**6), 10**8, 500)
    one = lambda x: [x, x, np.ones(len(x), np.int64), x, x]
    whole = adaptive.merged(0, one(at), 30)
    level, rows = 0, one(at[:0])
    for part in np.array_split(at, 9):
        level, rows = adaptive.merged(level, [np.concatenate(x) for x in zip(rows, one(part), strict=True)], 30)
    assert level == whole[0] and all((a == b).all() for a, b in zip(rows, whole[1], strict=True))
    assert adaptive.merged(0, one(at[:0]), 30)[0] == 0


def test_split_by_date(spark, tmp_path):
    rows = [(1, "s", "a", k, [None, 86400 * 365 * 26 + k, 5, 86400 * 365 * 40][k % 4]) for k in range(40)]
    stream = stream_of(spark, tmp_path / "in", [rows[:13], rows[13:]])
    summary.keep_by_date(stream, str(tmp_path / "out"), str(tmp_path / "ck"), "1995", "1998").awaitTermination(120)
    assert tuple(summary.read_date_counts(spark, str(tmp_path / "out")).first()) == (10, 10, 20)
    assert {x.post_no for x in summary.read_by_date(spark, str(tmp_path / "out"), "undated").collect()} == set(range(0, 40, 4))
    assert summary.read_by_date(spark, str(tmp_path / "out")).count() == 40
