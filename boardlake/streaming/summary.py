"""Streams of staged lines: a store that takes each post once, its summary, and buckets of post numbers over time.

Every batch writes under its own number, so one that runs again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boardlake.operators.aggregates import post_stats
from boardlake.operators.dedup import KEY, first_writer, merge_stats
from boardlake.operators.filters import range_counts, time_kind
from boardlake.operators.histogram import coarsen, fixed
from boardlake.plans.key_store import KeyStore
from boardlake.sources.json_posts import staged_posts, stored

KINDS = ("dated", "undated", "outside")


def staged_stream(spark: SparkSession, path: str, source_id: int) -> DataFrame:
    """New files of staged lines as posts; of the rows with one key the first that comes is kept, so the state grows with the keys."""
    lines = spark.readStream.schema("value string").option("lineSep", "\n").text(path)
    posts = stored(staged_posts(lines.select(F.regexp_replace("value", r"\r\z", "").alias("line"))))
    return posts.withColumn("source_id", F.lit(source_id)).dropDuplicates(KEY)


def keep_stats(posts: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Writes each batch's summary under its number, so a repeated batch replaces itself; `read_stats` adds them up."""

    def one(batch: DataFrame, number: int) -> None:
        post_stats(batch).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return posts.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_stats(spark: SparkSession, folder: str) -> DataFrame:
    return merge_stats(spark.read.option("basePath", folder).parquet(folder).drop("batch"))


def keep_posts(posts: DataFrame, folder: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Adds to the store in folder what it lacks: each batch's posts once, without keys of earlier batches. Undated posts are stored like others.

    Keys are kept in buckets (`KeyStore`), so a batch shuffles its own posts and reads the keys in place."""

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        keys, path = KeyStore(spark, f"{folder}/_keys", buckets), f"{folder}/batch={number}"
        keys.absent(first_writer(batch, ("source_id",)), F.col("part") < number).write.mode("overwrite").parquet(path)
        keys.put(spark.read.parquet(path), number)

    return posts.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_posts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("basePath", folder).parquet(folder).drop("batch")


def keep_buckets(posts: DataFrame, folder: str, checkpoint: str, width: int) -> StreamingQuery:
    """Writes the buckets of each batch; undated posts are in none. `read_buckets` merges them."""

    def one(batch: DataFrame, number: int) -> None:
        fixed(batch, width).write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return posts.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_buckets(spark: SparkSession, folder: str, width: int, wider: int | None = None) -> DataFrame:
    """The buckets over all batches, at their width or a multiple of it."""
    return coarsen(spark.read.option("basePath", folder).parquet(folder).drop("batch"), width, wider or width)


def keep_by_date(posts: DataFrame, folder: str, checkpoint: str, start: str | None = None, end: str | None = None) -> StreamingQuery:
    """One pass over each batch into three folders: posts dated in a range, undated ones and those outside it. The counts of each
    kind are observed on the way and stored under the batch's number."""

    def one(batch: DataFrame, number: int) -> None:
        seen = Observation()
        rows = batch.observe(seen, *range_counts(start, end)).withColumns({"batch": F.lit(number), "kind": time_kind(start, end)})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind", "batch").parquet(f"{folder}/rows")
        counts = batch.sparkSession.createDataFrame([tuple(seen.get[k] for k in KINDS)], ", ".join(f"{k} long" for k in KINDS))
        counts.write.mode("overwrite").parquet(f"{folder}/counts/batch={number}")

    return posts.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_by_date(spark: SparkSession, folder: str, kind: str | None = None) -> DataFrame:
    """The posts of one kind, or all with their kind; only that kind's files are read."""
    rows = spark.read.option("basePath", f"{folder}/rows").parquet(f"{folder}/rows").drop("batch")
    return rows if kind is None else rows.filter(F.col("kind") == kind).drop("kind")


def read_date_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row: how many posts of each kind came over all batches."""
    return spark.read.option("basePath", f"{folder}/counts").parquet(f"{folder}/counts").agg(*[F.sum(k).alias(k) for k in KINDS])
