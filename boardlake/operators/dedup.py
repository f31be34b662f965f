"""First-writer-wins over archives, and the joins and counts around it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import is_ghost

KEY = ["site", "board", "post_no"]


#: Where a row was read, if the reader tells; breaks ties of an archive with itself.
READ_AT = ("file", "row")


def first_writer(offers: DataFrame, order: tuple[str, ...] = ("source_rank",)) -> DataFrame:
    """One row for each key: the one that comes first by order, of several the one read first, and where that is not known the one with the least hash. An aggregation, so rows combine before the shuffle."""
    rest = [c for c in offers.columns if c not in KEY]
    first = [*order, *[c for c in READ_AT if c in rest and c not in order]]
    packed = F.struct(*[F.col(c) for c in first], *[F.col(c) for c in rest if c not in first])
    by = F.struct(*[F.col(c) for c in first], F.xxhash64(*[F.col(c) for c in rest]).alias("_hash"))
    return offers.groupBy(*KEY).agg(F.min_by(packed, by).alias("r")).select(*[F.col(c) if c in KEY else F.col(f"r.{c}").alias(c) for c in offers.columns])


def new_posts(offers: DataFrame, store: DataFrame, order: tuple[str, ...] = ("source_rank",)) -> DataFrame:
    """What of offers a store lacks, each key once."""
    return first_writer(offers, order).join(store.select(*KEY), KEY, "left_anti")


def audit(offers: DataFrame, by: tuple[str, ...] = ("source_rank",)) -> DataFrame:
    """For each archive: rows read, stored, duplicates and ghosts; the last three add up to the first."""
    real = offers.filter(~is_ghost(F.col("subnum")))
    stored = first_writer(real).groupBy(*by).agg(F.count("*").alias("stored"))
    read = offers.groupBy(*by).agg(F.count("*").alias("read"), F.count_if(is_ghost(F.col("subnum"))).alias("ghost"))
    out = read.join(stored, list(by), "left").withColumn("stored", F.coalesce("stored", F.lit(0)))
    return out.withColumn("dup", F.col("read") - F.col("ghost") - F.col("stored"))


def threads_once(threads: DataFrame) -> DataFrame:
    """One row for each thread reference; of several the greatest thread number, and none for number 0."""
    return threads.filter(F.col("thread_no") != 0).groupBy("thread_ref").agg(F.max(F.struct("thread_no", "board")).alias("t")).select("thread_ref", "t.thread_no", "t.board")


def with_threads(posts: DataFrame, threads: DataFrame) -> DataFrame:
    """Posts with their thread's board and number. Spark chooses the join; of a small threads table it makes a broadcast."""
    return posts.join(threads_once(threads), "thread_ref")


def without_thread(posts: DataFrame, threads: DataFrame) -> DataFrame:
    return posts.join(threads_once(threads).select("thread_ref"), "thread_ref", "left_anti")


def of_site(threads: DataFrame, site: str) -> DataFrame:
    """The threads of one site; those of others are dropped before posts are joined."""
    return threads.filter(F.col("site") == site)


def thread_audit(posts: DataFrame, threads: DataFrame, site: str) -> DataFrame:
    """One row: posts with a thread of the site (joined), with one of another site (foreign), and with none (no_thread)."""
    known = threads_once(threads).select("thread_ref")
    own = threads_once(of_site(threads, site)).select("thread_ref", F.lit(True).alias("own"))
    every = posts.select("thread_ref").join(known.withColumn("known", F.lit(True)), "thread_ref", "left").join(own, "thread_ref", "left")
    return every.agg(F.count("own").alias("joined"), F.count_if(F.col("own").isNull() & F.col("known").isNotNull()).alias("foreign"), F.count_if(F.col("known").isNull()).alias("no_thread"))


def merge_stats(*parts: DataFrame) -> DataFrame:
    """Summaries of the same cells added up; undated cells are cells of their own."""
    return reduce(DataFrame.unionByName, parts).groupBy("source_id", "site", "board", "year").agg(F.sum("posts").alias("posts"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))


def remaining_sources(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Sources of an ordered list after the completed ones, which must be its beginning."""
    return wanted.join(done.select("name"), "name", "left_anti").orderBy("rank")
