"""The keys of stored posts, bucketed and sorted on disk, so that new posts are told from known ones without a shuffle of the store."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.operators.dedup import KEY


@dataclass
class KeyStore:
    """A bucketed table in a folder, in parts that are written and read by number.

    A join with it shuffles the new rows alone, into as many partitions as the table has buckets; the number of buckets is
    that of the folder's first writer for good, so choose it for the size that the store will have.
    """

    spark: SparkSession
    folder: str
    buckets: int = 64

    def __post_init__(self):
        self.table = f"keys_{hashlib.md5(self.folder.encode()).hexdigest()}"
        keys = ", ".join(KEY)
        self.spark.sql(
            f"create table if not exists {self.table} (site string, board string, post_no bigint, part bigint) using parquet partitioned by (part) "
            f"clustered by ({keys}) sorted by ({keys}) into {self.buckets} buckets location '{self.folder}'"
        )
        if self.spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "hive":
            self.spark.sql(f"msck repair table {self.table}")

    def absent(self, posts: DataFrame, parts: Column) -> DataFrame:
        """The posts whose key is in none of the parts that a condition on `part` admits."""
        return posts.join(self.spark.table(self.table).filter(parts).select(*KEY), KEY, "left_anti")

    def put(self, posts: DataFrame, part: int) -> None:
        """Writes the keys of posts as a part; one of the same number is replaced, so a run that was stopped can be repeated."""
        rows = posts.select(*KEY).repartition(self.buckets, *KEY)
        self.spark.sql(f"insert overwrite table {self.table} partition (part = {int(part)}) select {', '.join(KEY)} from {{rows}}", rows=rows)
