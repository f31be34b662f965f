"""The archive as an object: posts, the summary table, and the commands over them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlake.functions.search import ENGLISH, Config
from boardlake.functions.times import minute_text
from boardlake.operators import aggregates, dedup, filters
from boardlake.plans.term_index import TermIndex


def render() -> Column:
    """A hit as text: date, board, number, thread, author, subject, and the body indented."""
    when = F.coalesce(minute_text(F.nullif(F.col("ts_utc"), F.lit(0))), F.lit("(no date)"))
    place = F.when(F.col("is_op"), F.lit("OP")).otherwise(F.concat(F.lit("in "), F.col("thread_no").cast("string")))
    subject = F.coalesce(F.concat(F.lit(" — “"), F.col("subject"), F.lit("”")), F.lit(""))
    body = F.coalesce(F.concat(F.lit("\n  "), F.replace(F.col("body_text"), F.lit("\n"), F.lit("\n  "))), F.lit(""))
    return F.concat(F.lit("["), when, F.lit("] /"), F.col("board"), F.lit("/"), F.col("post_no").cast("string"), F.lit(" ("), place, F.lit(")"), subject, body)


@dataclass
class PostStore:
    """A store of posts. Without a phrase, counts come from the summary, which has a row for each source, board and year. With an
    index of these posts, searches of its configuration read its postings instead of the texts."""

    posts: DataFrame
    stats: DataFrame | None = None
    index: TermIndex | None = None

    def _found(self, phrase: str, board: str | None, site: str | None, start: str | None, end: str | None, config: Config) -> DataFrame:
        rows = filters.by_time(filters.by_board(self.posts, board, site), start, end)
        if self.index is not None and self.index.config == config:
            return rows.join(self.index.phrase(phrase), dedup.KEY, "left_semi")
        return filters.by_phrase(rows, phrase, config)

    def where(self, text: str, config: Config = ENGLISH) -> DataFrame:
        """The posts that fulfil a condition such as `fat & (rat | !cat:*)`."""
        if self.index is not None and self.index.config == config:
            return self.index.find(text, self.posts)
        return filters.by_condition(self.posts, text, config)

    def count(self, phrase: str, by: str = "month", board: str | None = None, site: str | None = None, start: str | None = None, end: str | None = None, config: Config = ENGLISH) -> DataFrame:
        return aggregates.count_by(self._found(phrase, board, site, start, end, config), by)

    def search(self, phrase: str, board: str | None = None, site: str | None = None, start: str | None = None, end: str | None = None, limit: int | None = None, config: Config = ENGLISH) -> DataFrame:
        if limit is not None and limit < 1:
            raise ValueError("limit must be 1 or more")
        rows = self._found(phrase, board, site, start, end, config).orderBy(F.asc_nulls_last("ts_utc"), "post_no", "site", "board")
        return rows if limit is None else rows.limit(limit)

    def refresh_stats(self) -> PostStore:
        return PostStore(self.posts, aggregates.post_stats(self.posts))

    def list_boards(self, site: str | None = None) -> DataFrame:
        return aggregates.list_boards(filters.by_board(self.posts, site=site))

    def list_sites(self) -> DataFrame:
        return aggregates.list_sites(self.posts)

    def ingest(self, offers: DataFrame, order: tuple[str, ...] = ("source_rank",)) -> PostStore:
        """The store with what it lacks of offers; ghosts never enter. The summary grows by what was stored."""
        real = offers.filter(~filters.is_ghost(F.col("subnum"))) if "subnum" in offers.columns else offers
        new = dedup.new_posts(real, self.posts, order).select(*self.posts.columns)
        stats = aggregates.post_stats(new)
        return PostStore(self.posts.unionByName(new), stats if self.stats is None else dedup.merge_stats(self.stats, stats))

    def survey(self, by: str = "month", boards: list[str] | None = None, distinct: bool = False, per_board: bool = False) -> dict[str, DataFrame]:
        """What these posts would offer a store: a table by board, and one by month or year over all boards or for each (per_board)."""
        rows = filters.only_boards(self.posts, boards) if boards else self.posts
        out = {"boards": aggregates.survey_boards(rows), "buckets": aggregates.survey_buckets(rows, by)}
        if distinct:
            out["distinct"] = aggregates.survey_distinct(rows)
        if per_board:
            out["board_buckets"] = aggregates.survey_board_buckets(rows, by)
        return out

    def search_index(self, index: TermIndex, phrase: str) -> DataFrame:
        """Posts that hold the phrase, found through an index instead of their texts."""
        return self.posts.join(index.phrase(phrase), dedup.KEY, "left_semi")
