"""Adaptive histograms on a stream: a state of bounded size for each series, which doubles its width when it is full.

A state holds at most twice the target of buckets, each with its first and last time, posts, and least and greatest number. A
series is dealt over `SALTS` states, so a hot one is not one task's; states merge, since a bucket of any width is part of one
of each greater width. Merged, they are the buckets of the least width that keeps to the bound over all posts, whatever the
batches were.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from boardlake.operators.histogram import SERIES

SALTS, MOST = 8, 62
COLUMNS = ["first_ts", "last_ts", "posts", "low_no", "high_no"]
STATE = "level int, " + ", ".join(f"{c} array<bigint>" for c in COLUMNS)


def merged(level: int, rows: list[np.ndarray], most: int, origin: int = 0) -> tuple[int, list[np.ndarray]]:
    """Buckets of 2 ** level seconds or the least greater width with at most `most` of them, from buckets of that width or less."""
    order = np.argsort(rows[0], kind="stable")
    rows = [r[order] for r in rows]
    while True:
        number = (rows[0] - origin) >> level
        starts = np.flatnonzero(np.diff(number, prepend=number[:1] - 1)) if len(number) else np.zeros(0, np.int64)
        if len(starts) <= most or level == MOST:
            break
        level += 1
    if not len(starts):
        return level, rows
    by = (np.minimum, np.maximum, np.add, np.minimum, np.maximum)
    return level, [f.reduceat(r, starts) for f, r in zip(by, rows, strict=True)]


def keep_adaptive(posts: DataFrame, folder: str, checkpoint: str, target: int, origin: int = 0, series: list[str] = SERIES, salts: int = SALTS) -> StreamingQuery:
    """Writes the states that a batch changes under its number; undated posts are in none. `read_adaptive` merges the last of each."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        level, rows = 0, [np.zeros(0, np.int64)] * len(COLUMNS)
        if state.exists:
            level, *held = state.get
            rows = [np.array(h, np.int64) for h in held]
        for batch in batches:
            at, no = batch["ts_utc"].to_numpy(np.int64), batch["post_no"].to_numpy(np.int64)
            new = [at, at, np.ones(len(at), np.int64), no, no]
            level, rows = merged(level, [np.concatenate(x) for x in zip(rows, new, strict=True)], 2 * target, origin)
        state.update((level, *[r.tolist() for r in rows]))
        yield pd.DataFrame(dict(zip([*series, "salt"], key, strict=True)) | {"level": level} | dict(zip(COLUMNS, rows, strict=True)))

    def one(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    dated = posts.filter("ts_utc is not null").select(*series, F.col("ts_utc").cast("long").alias("ts_utc"), F.col("post_no").cast("long").alias("post_no"), F.pmod(F.xxhash64("post_no"), F.lit(salts)).cast("int").alias("salt"))
    kinds = {f.name: f.dataType.simpleString() for f in dated.schema}
    out = ", ".join([*(f"{c} {kinds[c]}" for c in [*series, "salt"]), "level int", *(f"{c} bigint" for c in COLUMNS)])
    states = dated.groupBy(*series, "salt").applyInPandasWithState(update, out, STATE, "update", GroupStateTimeout.NoTimeout)
    return states.writeStream.foreachBatch(one).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_states(states: DataFrame, target: int, origin: int = 0, series: list[str] = SERIES) -> DataFrame:
    """The buckets of each series at the least width 2 ** k with at most 2 * target of them, from the buckets of its states."""
    least = states.groupBy(*series).agg(F.max("level").alias("least"))
    at = F.col("first_ts") - origin
    # each state's buckets are few, so every width from the greatest of the states' is counted
    levels = states.join(least, series).select(*series, F.explode(F.transform(F.sequence("least", F.lit(MOST)), lambda k: F.struct(k.alias("k"), F.floor(at / F.pow(F.lit(2.0), k)).alias("b")))).alias("x"))
    width = levels.select(*series, "x.k", "x.b").distinct().groupBy(*series, "k").agg(F.count("*").alias("n")).filter(F.col("n") <= 2 * target)
    width = width.groupBy(*series).agg(F.pow(F.lit(2.0), F.min("k")).cast("long").alias("width"))
    bucket = F.floor(at / F.col("width")).alias("bucket")
    sums = [F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("posts").alias("posts"), F.min("low_no").alias("low_no"), F.max("high_no").alias("high_no")]
    return states.join(width, series).groupBy(*series, "width", bucket).agg(*sums)


def read_adaptive(spark: SparkSession, folder: str, target: int, origin: int = 0, series: list[str] = SERIES) -> DataFrame:
    """The histograms over all batches; series that are null are not told apart from none."""
    rows = spark.read.option("basePath", folder).parquet(folder)
    last = rows.groupBy(*series, "salt").agg(F.max("batch").alias("batch"))
    return merge_states(rows.join(last, [*series, "salt", "batch"]).drop("salt", "batch"), target, origin, series)
