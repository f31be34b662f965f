"""Predicates over posts: search, boards, times, ghosts, numbers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.functions.search import ENGLISH, Config, Terms, condition, holds_phrase, matches, searched_text
from boardlake.functions.times import parse_bound


def by_phrase(posts: DataFrame, phrase: str, config: Config = ENGLISH) -> DataFrame:
    return posts.filter(holds_phrase(searched_text(F.col("subject"), F.col("body_text")), phrase, config))


def by_terms(posts: DataFrame, where: Callable[[Terms], Column], config: Config = ENGLISH) -> DataFrame:
    """Posts that fulfil a condition over their terms, as `lambda t: t.follow("a", "b") & ~t.word("c") | t.prefix("d")`."""
    return posts.filter(matches(searched_text(F.col("subject"), F.col("body_text")), where, config))


def by_condition(posts: DataFrame, text: str, config: Config = ENGLISH) -> DataFrame:
    """Posts that fulfil a condition from text, as `fat & (rat | !cat:*)` or `a <-> b`; see `search.condition`."""
    return posts.filter(condition(text, config).holds(searched_text(F.col("subject"), F.col("body_text")), config))


def by_board(posts: DataFrame, board: str | None = None, site: str | None = None) -> DataFrame:
    for name, value in (("board", board), ("site", site)):
        posts = posts if value is None else posts.filter(F.col(name) == value)
    return posts


def by_time(posts: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Posts from start up to the end of the unit that end names; undated posts go once a bound is given."""
    if start is not None:
        posts = posts.filter(F.col("ts_utc") >= parse_bound(start))
    return posts if end is None else posts.filter(F.col("ts_utc") < parse_bound(end, end=True))


def time_kind(start: str | None = None, end: str | None = None) -> Column:
    """What a ranged scan does with a post: "dated" (it is in the range), "outside", or "undated"."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col("ts_utc") >= parse_bound(start))
    if end is not None:
        inside = inside & (F.col("ts_utc") < parse_bound(end, end=True))
    return F.when(F.col("ts_utc").isNull(), "undated").when(inside, "dated").otherwise("outside")


def range_counts(start: str | None = None, end: str | None = None) -> list[Column]:
    """Aggregates that count the kinds of `time_kind`, for a report or for `observe` beside a scan that drops rows."""
    kind = time_kind(start, end)
    return [F.count_if(kind == k).alias(k) for k in ("dated", "undated", "outside")]


def range_report(posts: DataFrame, start: str | None = None, end: str | None = None, by: Sequence[str] = ("source_id", "board")) -> DataFrame:
    """For each source and board the rows in a range, those without a date, and those outside it."""
    return posts.groupBy(*by).agg(*range_counts(start, end))


def like(column: str, pattern: str | None) -> Column:
    """LIKE, where no pattern fits all that is not null."""
    return F.col(column).like(pattern or "%")


def without_boards(posts: DataFrame, boards: Sequence[str]) -> DataFrame:
    """Boards excluded in any case of letters."""
    return posts.filter(~F.lower("board").isin([b.lower() for b in boards])) if boards else posts


def excluded_tally(posts: DataFrame, boards: Sequence[str]) -> DataFrame:
    """How many rows of each excluded board were left out."""
    return posts.filter(F.lower("board").isin([b.lower() for b in boards])).groupBy("board").agg(F.count("*").alias("excluded"))


def only_boards(posts: DataFrame, boards: Sequence[str]) -> DataFrame:
    return posts.filter(F.col("board").isin(list(boards)))


def is_ghost(subnum: Column) -> Column:
    return F.coalesce(subnum.try_cast("double"), F.lit(0.0)) != 0


def valid_number(text: Column) -> Column:
    """The positive integer of a text, else null."""
    n = text.try_cast("bigint")
    return F.when(n > 0, n)
