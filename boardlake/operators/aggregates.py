"""Counts over time, listings, coverage and surveys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlake.functions.times import bucket_key, minute_text, month_key, utc_date, year_of


def count_by(posts: DataFrame, by: str) -> DataFrame:
    """bucket, posts; undated posts are the bucket null, which comes last."""
    return posts.groupBy(bucket_key(F.col("ts_utc"), by).alias("bucket")).agg(F.count("*").alias("posts")).orderBy(F.asc_nulls_last("bucket"))


def post_stats(posts: DataFrame) -> DataFrame:
    """The summary by source, site, board and year; undated posts have the year null, so totals agree."""
    year = year_of(F.col("ts_utc")).alias("year")
    return posts.groupBy("source_id", "site", "board", year).agg(F.count("*").alias("posts"), F.min("ts_utc").alias("min_ts"), F.max("ts_utc").alias("max_ts"))


def board_list(stats: DataFrame) -> DataFrame:
    return stats.groupBy("site", "board").agg(F.sum("posts").alias("posts"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def board_years(stats: DataFrame, board: str, site: str) -> DataFrame:
    return stats.filter((F.col("board") == board) & (F.col("site") == site) & F.col("year").isNotNull()).groupBy("year").agg(F.sum("posts").alias("posts"))


def has_stats(stats: DataFrame) -> DataFrame:
    """One row: whether there is any summary row."""
    return stats.limit(1).agg((F.count("*") > 0).alias("has_stats"))


def list_boards(posts: DataFrame) -> DataFrame:
    day = F.date_format(utc_date(F.col("ts_utc")), "yyyy-MM-dd")
    return posts.groupBy("site", "board").agg(F.count("*").alias("posts"), F.count_distinct("thread_no").alias("threads"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def list_sites(posts: DataFrame) -> DataFrame:
    day = F.date_format(utc_date(F.col("ts_utc")), "yyyy-MM-dd")
    return posts.groupBy("site").agg(F.count_distinct("board").alias("boards"), F.count("*").alias("posts"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def coverage_by_source(stats: DataFrame, sources: DataFrame, site: str | None = None, board: str | None = None) -> DataFrame:
    kept = stats.filter(F.col("site").like(site or "%") & F.col("board").like(board or "%") & F.col("year").isNotNull())
    return kept.join(sources, "source_id").groupBy("year", "name").agg(F.sum("posts").alias("posts"))


def coverage_by_year(stats: DataFrame, site: str | None = None, board: str | None = None) -> DataFrame:
    kept = stats.filter(F.col("site").like(site or "%") & F.col("board").like(board or "%") & F.col("year").isNotNull())
    return kept.groupBy("year").agg(F.sum("posts").alias("posts"))


def corpus_totals(stats: DataFrame) -> DataFrame:
    return stats.agg(F.coalesce(F.sum("posts"), F.lit(0)).alias("posts"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))


def timestamp_span(posts: DataFrame) -> DataFrame:
    per = posts.groupBy("source_id").agg(F.min("ts_utc").alias("lo"), F.max("ts_utc").alias("hi"))
    return per.agg(F.min("lo").alias("min_ts"), F.max("hi").alias("max_ts"))


def heap_totals(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count("*").alias("posts"), F.min("ts_utc").alias("min_ts"), F.max("ts_utc").alias("max_ts"))


def by_year_and_source(posts: DataFrame) -> DataFrame:
    dated = posts.filter(F.col("ts_utc").isNotNull())
    return dated.groupBy("source_id", year_of(F.col("ts_utc")).alias("year")).agg(F.count("*").alias("posts"))


def filled_years(counts: DataFrame) -> DataFrame:
    """year, posts with a row for every year from the first to the last."""
    span = counts.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).filter(F.col("lo").isNotNull())
    years = span.select(F.explode(F.sequence("lo", "hi")).alias("year"))
    return years.join(counts, "year", "left").select("year", F.coalesce("posts", F.lit(0)).alias("posts"))


def board_years_filled(posts: DataFrame, board: str) -> DataFrame:
    """year, posts of all dated posts of one board, with zeros for the years between that have none."""
    dated = posts.filter((F.col("board") == board) & F.col("ts_utc").isNotNull())
    return filled_years(dated.groupBy(year_of(F.col("ts_utc")).alias("year")).agg(F.count("*").alias("posts")))


def coverage_grid(stats: DataFrame) -> DataFrame:
    """Every source in every year of the span, with zeros."""
    dated = stats.filter(F.col("year").isNotNull())
    cells = dated.groupBy("source_id", "year").agg(F.sum("posts").alias("posts"))
    span = dated.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).filter(F.col("lo").isNotNull()).select(F.sequence("lo", "hi").alias("years"))
    grid = dated.select("source_id").distinct().join(F.broadcast(span)).select("source_id", F.explode("years").alias("year"))
    return grid.join(cells, ["source_id", "year"], "left").select("source_id", "year", F.coalesce("posts", F.lit(0)).alias("posts"))


def source_ranking(stats: DataFrame) -> DataFrame:
    return stats.groupBy("source_id").agg(F.sum("posts").alias("posts")).orderBy(F.desc("posts"), "source_id")


def survey_boards(posts: DataFrame) -> DataFrame:
    ts = F.col("ts_utc")
    return posts.groupBy("site", "board").agg(
        F.count("*").alias("posts"), F.count_if("is_op").alias("ops"), F.count_if(ts.isNull()).alias("undated"), F.min("post_no").alias("min_post_no"), F.max("post_no").alias("max_post_no"),
        minute_text(F.min(ts)).alias("first_at"), minute_text(F.max(ts)).alias("last_at"),
    )


def survey_distinct(posts: DataFrame) -> DataFrame:
    return posts.groupBy("site", "board").agg(F.count("*").alias("posts"), F.count_distinct("post_no").alias("distinct_posts"))


def survey_totals(posts: DataFrame) -> DataFrame:
    per = posts.groupBy("site", "board").agg(F.count("*").alias("posts"), F.count_distinct("post_no").alias("distinct_posts"), F.min("ts_utc").alias("lo"), F.max("ts_utc").alias("hi"))
    return per.agg(F.sum("posts").alias("posts"), F.sum("distinct_posts").alias("distinct_posts"), (F.sum("posts") - F.sum("distinct_posts")).alias("repeats"), F.min("lo").alias("min_ts"), F.max("hi").alias("max_ts"))


def survey_buckets(posts: DataFrame, by: str = "month") -> DataFrame:
    """Counts by month or year, "(undated)", and "TOTAL" over all."""
    key = F.coalesce(bucket_key(F.col("ts_utc"), by), F.lit("(undated)")).alias("bucket")
    return posts.rollup(key).agg(F.count("*").alias("posts")).select(F.coalesce("bucket", F.lit("TOTAL")).alias("bucket"), "posts")


def survey_board_buckets(posts: DataFrame, by: str = "month") -> DataFrame:
    """survey_buckets for each board."""
    key = F.coalesce(bucket_key(F.col("ts_utc"), by), F.lit("(undated)")).alias("bucket")
    return posts.groupBy("site", "board", key).agg(F.count("*").alias("posts"))


def months_of(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("ts_utc").isNotNull()).groupBy("site", "board", month_key(F.col("ts_utc")).alias("month")).agg(F.count("*").alias("posts"))


def dry_run_report(posts: DataFrame) -> DataFrame:
    """Rows, openers and undated rows by board, and for all boards (board null)."""
    return posts.rollup("board").agg(F.count("*").alias("posts"), F.count_if("is_op").alias("ops"), F.count_if(F.col("ts_utc").isNull()).alias("undated"))


def latest_post(posts: DataFrame) -> DataFrame:
    """By board: the thread that changed last, when, and its greatest post number."""
    threads = posts.groupBy("board", "thread_no").agg(F.max("ts_utc").alias("last_modified"), F.max("post_no").alias("last"))
    newest = threads.filter(F.col("last_modified").isNotNull()).groupBy("board").agg(F.max(F.struct("last_modified", "thread_no", "last")).alias("t"))
    return newest.select("board", F.col("t.thread_no").alias("thread"), F.col("t.last_modified").alias("last_modified"), F.col("t.last").alias("last"))


def per_100k(hits: DataFrame, posts: DataFrame) -> DataFrame:
    """Hits by year against all posts of the year, for each 100,000."""
    year = year_of(F.col("ts_utc")).alias("year")
    h = hits.filter(F.col("ts_utc").isNotNull()).groupBy(year).agg(F.count("*").alias("hits"))
    t = posts.filter(F.col("ts_utc").isNotNull()).groupBy(year).agg(F.count("*").alias("posts"))
    return h.join(t, "year", "left").select("year", "hits", "posts", F.round(F.try_divide("hits", "posts") * 100000, 2).alias("rate"))
