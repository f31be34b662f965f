"""Views of the archive model over the driver's tables, as DataFrames and as SQL text for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.times import day_seconds

#: Boards of the posts view; the place in this list takes part in a thread's id.
BOARDS = ["de", "en", "es", "fr"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts: board is the language, a thread is a block of eight, dates come from orders, every 17th is undated."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    id_ = F.col("doc_id")
    ts = F.when(id_ % 17 == 0, None).otherwise(day_seconds(F.to_date("o_orderdate")) + id_ * 37 % 86400)
    return d.join(o, d["doc_id"] == o["o_orderkey"], "left").select(
        F.substr("source", F.lit(4)).cast("int").alias("source_id"), "source", F.lit("site0").alias("site"), F.col("lang").alias("board"),
        (id_ - id_ % 8).alias("thread_no"), id_.alias("post_no"), (id_ % 8 == 0).alias("is_op"), ts.alias("ts_utc"),
        F.when(id_ % 8 == 0, F.substring_index("text", "\n", 1)).alias("subject"), F.col("text").alias("body_text"),
    )


POSTS = """posts as (select cast(substr(d.source, 4) as int) as source_id, d.source, 'site0' as site, d.lang as board,
 d.doc_id - d.doc_id % 8 as thread_no, d.doc_id as post_no, d.doc_id % 8 = 0 as is_op,
 case when d.doc_id % 17 = 0 then null else cast(epoch(o.o_orderdate) as bigint) + d.doc_id * 37 % 86400 end as ts_utc,
 case when d.doc_id % 8 = 0 then split_part(d.text, chr(10), 1) end as subject, d.text as body_text
 from documents d left join orders o on d.doc_id = o.o_orderkey)"""


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts as two archives offer them: rank 1 without every third, rank 2 the even ones with a mark; some are ghosts."""
    p = posts(spark, sf_dir)
    ghost = (F.col("post_no") % 29 == 0).cast("int").alias("subnum")
    first = p.filter("post_no % 3 <> 0").select("*", F.lit(1).alias("source_rank"), ghost)
    second = p.filter("post_no % 2 = 0").withColumn("body_text", F.concat("body_text", F.lit(" [later]"))).select("*", F.lit(2).alias("source_rank"), ghost)
    return first.unionByName(second)


OFFERS = POSTS + """, offers as (select *, 1 as source_rank, cast(post_no % 29 = 0 as int) as subnum from posts where post_no % 3 <> 0
 union all select * replace (body_text || ' [later]' as body_text), 2 as source_rank, cast(post_no % 29 = 0 as int) as subnum from posts where post_no % 2 = 0)"""


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each thread of a board, some missing: thread_ref, board, thread_no."""
    ref = F.col("thread_no") * 4 + F.array_position(F.array(*[F.lit(b) for b in BOARDS]), F.col("board")) - 1
    return posts(spark, sf_dir).select("board", "thread_no").distinct().filter("thread_no div 8 % 33 <> 0").select(ref.alias("thread_ref"), "board", "thread_no")


THREADS = POSTS + f""", threads as (select distinct thread_no * 4 + list_position({BOARDS}, board) - 1 as thread_ref, board, thread_no
 from posts where thread_no // 8 % 33 <> 0)"""


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as posts: board is the type, thread the user."""
    e = table(spark, sf_dir, "events")
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return e.select(F.lit("site0").alias("site"), F.col("event_type").alias("board"), F.col("user_id").alias("thread_no"), F.col("event_id").alias("post_no"), seconds.alias("ts_utc"), F.col("props").alias("body_text"))


EVENT_POSTS = "event_posts as (select 'site0' as site, event_type as board, user_id as thread_no, event_id as post_no, cast(floor(epoch(ts)) as bigint) as ts_utc, props as body_text from events)"

#: Invented board history: two April-Fools pairs, a board made on 1 April that stays, a month without a day, an undated one.
TIMELINE = [
    ("created", "aa", "2003-10-01"), ("created", "bb", "2004-01-15"), ("created", "cc", "2006-04-01"), ("removed", "cc", "2006-04-03"),
    ("created", "dd", "2008-02-10"), ("removed", "bb", "2008-12"), ("created", "ee", "2010-04-01"), ("created", "ff", "2014-04-02"),
    ("removed", "ff", "2014-04-08"), ("created", "gg", "2014-05-01"), ("created", "hh", None), ("removed", "dd", "2021-07-07"),
]


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(TIMELINE, "type string, slug string, date string")


TIMELINE_SQL = "timeline as (select * from (values " + ", ".join(f"('{t}', '{s}', {repr(d) if d else 'null'})" for t, s, d in TIMELINE) + ") v(type, slug, date))"
