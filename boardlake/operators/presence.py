"""Which post numbers an archive holds: bitmaps, ratios and density pyramids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def bitmaps(posts: DataFrame, by: list[str]) -> DataFrame:
    """A bitmap for each range of numbers; built in part before the shuffle."""
    n = F.col("post_no")
    return posts.groupBy(*by, F.bitmap_bucket_number(n).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits"), F.count("*").alias("rows"), F.max(n).alias("max_no"))


def bitmap_counts(maps: DataFrame, by: list[str]) -> DataFrame:
    return maps.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("present"), F.sum("rows").alias("rows"), F.max("max_no").alias("max_no"))


def has_post(wanted: DataFrame, posts: DataFrame) -> DataFrame:
    """wanted (board, post_no) with whether posts hold it."""
    held = posts.select("board", "post_no").distinct().withColumn("present", F.lit(True))
    return wanted.join(held, ["board", "post_no"], "left").withColumn("present", F.coalesce("present", F.lit(False)))


def board_last(posts: DataFrame) -> DataFrame:
    return posts.groupBy("board").agg(F.max("post_no").alias("last"))


def row_width(cells: Column, step: int = 256) -> Column:
    """The width of a near-square grid, a multiple of step."""
    return (F.ceil(F.ceil(F.sqrt(cells)) / step) * step).cast("long")


def layout(last: DataFrame, step: int = 256) -> DataFrame:
    """last (board, last) with the grid of numbers 1 .. last."""
    width = row_width(F.col("last"), step)
    return last.withColumns({"row_width": width, "grid_rows": F.ceil(F.col("last") / width).cast("long")})


def ratio(posts: DataFrame, last: DataFrame) -> DataFrame:
    """Distinct numbers present in 1 .. last, by source and board."""
    inside = posts.join(last, "board").filter(F.col("post_no").between(1, F.col("last")))
    return inside.groupBy("source_id", "board").agg(F.count_distinct("post_no").alias("present"), F.max("last").alias("cells"))


def pyramid(posts: DataFrame, grid: DataFrame, levels: list[int]) -> DataFrame:
    """Blocks of k x k numbers with what is present of what is in range, for each k, coarser ones from the finest."""
    cell = F.col("post_no") - 1
    cells = posts.select("board", "post_no").distinct().join(grid, "board").filter(F.col("post_no").between(1, F.col("last")))
    fine = levels[0]
    if any(k % fine for k in levels):
        raise ValueError(f"levels are no multiples of {fine}")
    finest = cells.groupBy("board", "row_width", "last", F.floor(F.floor(cell / F.col("row_width")) / fine).alias("fy"), F.floor(cell % F.col("row_width") / fine).alias("fx")).agg(F.count("*").alias("part"))
    each = finest.withColumn("k", F.explode(F.array(*[F.lit(k) for k in levels])))
    step = F.col("k") / fine
    out = each.groupBy("board", "row_width", "last", "k", F.floor(F.col("fy") / step).alias("y"), F.floor(F.col("fx") / step).alias("x")).agg(F.sum("part").alias("present"))
    # cells of a block in range: full rows of the block and the part of the last row
    w, k, last = F.col("row_width"), F.col("k"), F.col("last")
    full, rest = F.floor(last / w), last % w
    rows = F.greatest(F.least((F.col("y") + 1) * k, full) - F.col("y") * k, F.lit(0))
    wide = F.least((F.col("x") + 1) * k, w) - F.col("x") * k
    partial = F.when((full >= F.col("y") * k) & (full < (F.col("y") + 1) * k), F.greatest(F.least((F.col("x") + 1) * k, rest) - F.col("x") * k, F.lit(0))).otherwise(0)
    of = (rows * wide + partial).cast("long")
    return out.withColumn("cells", of).withColumn("opacity", F.when(F.col("present") == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.col("present") * 255 / F.col("cells") + 0.5))).cast("int")).select("board", "k", "y", "x", "present", "cells", "opacity")


def tiles(blocks: DataFrame, size: int = 256) -> DataFrame:
    """The tiles that hold any block; blank ones do not appear."""
    return blocks.groupBy("board", "k", F.floor(F.col("y") / size).alias("tile_y"), F.floor(F.col("x") / size).alias("tile_x")).agg(F.count("*").alias("pixels"))


def board_views(maps: DataFrame) -> DataFrame:
    """For each board the grid that most of its maps share, of several the one that goes furthest, and its members by density."""
    votes = maps.groupBy("board", "last").agg(F.count("*").alias("maps"))
    best = votes.groupBy("board").agg(F.max(F.struct("maps", "last")).alias("b")).select("board", F.col("b.last").alias("last"))
    place = F.row_number().over(Window.partitionBy("board").orderBy(F.desc("present"), "source_id"))
    return maps.join(best, ["board", "last"]).withColumn("place", place).select("board", "last", "source_id", "present", "place")
