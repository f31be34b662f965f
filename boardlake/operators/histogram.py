"""Post numbers over time: buckets of a fixed, adaptive or common width."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SERIES = ["source_id", "site", "board"]


def fixed(posts: DataFrame, width: float | Column, origin: int = 0, series: list[str] = SERIES) -> DataFrame:
    """For each bucket: its number, first and last time, posts, least and greatest number. Buckets can be merged."""
    key = F.floor((F.col("ts_utc") - origin) / (F.lit(width) if isinstance(width, (int, float)) else width)).alias("bucket")
    return posts.filter(F.col("ts_utc").isNotNull()).groupBy(*series, key).agg(F.min("ts_utc").alias("first_ts"), F.max("ts_utc").alias("last_ts"), F.count("*").alias("posts"), F.min("post_no").alias("low_no"), F.max("post_no").alias("high_no"))


def coarsen(buckets: DataFrame, width: int, wider: int, origin: int = 0, series: list[str] = SERIES) -> DataFrame:
    """Buckets of a whole multiple of their width."""
    if wider % width:
        raise ValueError(f"{wider} is no multiple of {width}")
    key = F.floor((F.col("first_ts") - origin) / wider).alias("bucket")
    return buckets.groupBy(*series, key).agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("posts").alias("posts"), F.min("low_no").alias("low_no"), F.max("high_no").alias("high_no"))


#: Levels that are counted inside blocks of 2 ** BLOCK seconds; wider ones are counted from the blocks.
BLOCK = 16


def adaptive_width(posts: DataFrame, target: int, origin: int = 0, series: list[str] = SERIES, most: int = 32) -> DataFrame:
    """For each series the least width 2 ** k, in seconds, with at most 2 * target buckets.

    Two neighbouring times lie in different buckets of 2 ** k if the highest bit in which they differ is k or above, so one
    pass over the distinct times, sorted within blocks of 2 ** BLOCK seconds, counts the buckets of all narrow levels; the
    wide ones are counted from the blocks alone, which are few. A series of any size is dealt by its blocks.
    """
    dated = posts.filter(F.col("ts_utc").isNotNull()).select(*series, (F.col("ts_utc") - origin).alias("t")).distinct()
    block = F.floor(F.col("t") / 2**BLOCK).alias("b")
    before = F.lag("t").over(Window.partitionBy(*series, "b").orderBy("t"))
    bits = F.length(F.bin(F.col("t").bitwiseXOR(F.col("before"))))  # the highest differing bit, counted from 1
    steps = dated.select(*series, "t", block).withColumn("before", before)
    steps = steps.groupBy(*series, F.when(F.col("before").isNull(), BLOCK + 1).otherwise(bits).alias("bits")).agg(F.count("*").alias("n"))
    narrow = steps.select(*series, F.explode(F.sequence(F.lit(0), F.least("bits", F.lit(BLOCK)) - 1)).alias("k"), "n").groupBy(*series, "k").agg(F.sum("n").alias("n"))
    blocks = dated.select(*series, block).distinct()
    wide = blocks.select(*series, F.explode(F.transform(F.sequence(F.lit(BLOCK), F.lit(most)), lambda k: F.struct(k.alias("k"), F.floor(F.col("b") / F.pow(F.lit(2.0), k - BLOCK)).alias("b")))).alias("x"))
    wide = wide.select(*series, "x.k", "x.b").distinct().groupBy(*series, "k").agg(F.count("*").alias("n"))
    return narrow.unionByName(wide).filter(F.col("n") <= 2 * target).groupBy(*series).agg(F.pow(F.lit(2.0), F.min("k")).cast("long").alias("width"))


def adaptive(posts: DataFrame, target: int, origin: int = 0, series: list[str] = SERIES) -> DataFrame:
    wide = posts.join(adaptive_width(posts, target, origin, series), series)
    return fixed(wide, F.col("width"), origin, [*series, "width"])


def common(posts: DataFrame, target: int, origin: int = 0, series: list[str] = SERIES) -> DataFrame:
    """All series at the greatest of their widths; one number joins all rows."""
    width = adaptive_width(posts, target, origin, series).agg(F.max("width").alias("width"))
    return fixed(posts.join(F.broadcast(width)), F.col("width"), origin, [*series, "width"])


def points(buckets: DataFrame, series: list[str] = SERIES) -> DataFrame:
    """The least and greatest number of each bucket, at its first time."""
    return buckets.select(*series, F.col("first_ts").alias("ts_utc"), F.explode(F.array_distinct(F.array("low_no", "high_no"))).alias("post_no"))
