"""Saved pages: which board they belong to, and what to do with those that lie elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_mode(page: str, items: Column, pages: DataFrame) -> DataFrame:
    """For each page the most frequent item of its array, of several the one that comes first."""
    each = pages.select(page, F.posexplode(items).alias("at", "item"))
    counts = each.groupBy(page, "item").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    return counts.groupBy(page).agg(F.max_by("item", F.struct("n", -F.col("first"))).alias("item"), F.max("n").alias("n"))


def link_boards(html: Column) -> Column:
    """Boards that a page's form action names, or else all that its links name, in order and lower case."""
    form = F.regexp_extract_all(html, F.lit(r'(?i)<form[^>]*action="[^"]*/([a-z0-9]+)/post'), F.lit(1))
    links = F.regexp_extract_all(html, F.lit(r'(?i)href="[^"]*?/([a-z0-9]+)/'), F.lit(1))
    lower = lambda a: F.transform(a, lambda x: F.lower(x))
    return F.when(F.size(form) > 0, lower(form)).otherwise(lower(links))


def reconcile(pages: DataFrame) -> DataFrame:
    """A plan for pages (path, dir_board, name, html): keep, move, remove (equal bytes are there) or snapshot (.snapN).

    The board that the links name decides, the title never does. Nothing is moved here.
    """
    board = first_mode("path", link_boards(F.col("html")), pages.select("path", "html"))
    known = pages.join(board.select("path", F.col("item").alias("linked")), "path", "left")
    known = known.select("path", "dir_board", "name", F.coalesce("linked", "dir_board").alias("board"), F.sha1(F.col("html").cast("binary")).alias("digest"))
    home = F.when(F.col("dir_board") == F.col("board"), 0).otherwise(1)
    place = Window.partitionBy("board", "name").orderBy(home, "path")
    same = Window.partitionBy("board", "name", "digest").orderBy(home, "path")
    ranked = known.withColumns({"copy": F.row_number().over(same), "at": F.row_number().over(place)})
    snaps = Window.partitionBy("board", "name", F.col("copy") == 1).orderBy("at")
    ranked = ranked.withColumn("snap", F.row_number().over(snaps) - 1)
    action = F.when(F.col("copy") > 1, "remove").when(F.col("snap") > 0, "snapshot").when(F.col("dir_board") != F.col("board"), "move").otherwise("keep")
    target = F.when(F.col("copy") > 1, None).when(F.col("snap") > 0, F.concat("name", F.lit(".snap"), F.col("snap").cast("string"))).otherwise(F.col("name"))
    return ranked.select("path", "dir_board", "board", action.alias("action"), target.alias("target"))
