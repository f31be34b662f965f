"""Every query of the archive operators by name, with the SQL that gives the same rows on the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions import search, texts, times
from boardlake.functions.scratch import shared_folder, text_files
from boardlake.operators import aggregates as A
from boardlake.operators import dedup as D
from boardlake.operators import filters as P
from boardlake.operators import headers as O
from boardlake.operators import histogram as H
from boardlake.operators import pages as G
from boardlake.operators import presence as B
from boardlake.operators import timelines as L
from boardlake.sources import html_posts as X
from boardlake.sources import json_posts as J
from boardlake.sources import mysql_dump as M
from boardlake.sources import saved_pages
from boardlake.sources import warc as W
from boardlake.streaming import histogram as V
from boardlake.streaming import summary as S

from .archive import Archive
from .term_index import TermIndex
from .views import EVENT_POSTS, OFFERS, POSTS, THREADS, TIMELINE_SQL, event_posts, offers, posts, table, threads, timeline

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, base: str = POSTS):
    """Registers a function as a query under its name, and its SQL over the views of base."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = f"with {base} {sql}"
        return f

    return add


DATE = "strftime(make_timestamp(ts_utc * 1000000), '{}')"
YEAR = "cast(year(make_timestamp(ts_utc * 1000000)) as int)"
STATS = POSTS + f", stats as (select source_id, site, board, {YEAR} as year, count(*) as posts, min(ts_utc) as min_ts, max(ts_utc) as max_ts from posts group by all)"
TOKENS = r"regexp_extract_all(lower(coalesce(subject, '') || ' ' || coalesce(body_text, '')), '[\p{L}\p{N}]+')"
JOINED = f"' ' || array_to_string({TOKENS}, ' ') || ' '"
HITS = f"hits as (select * from posts where contains({JOINED}, ' with the '))"


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return A.post_stats(posts(spark, sf))


def hits(spark: SparkSession, sf: str) -> DataFrame:
    return P.by_phrase(posts(spark, sf), "with the", search.SIMPLE)


# ---- filters and search


@query(f"select post_no, board from posts where contains({JOINED}, ' with the ')")
def filter_phrase(spark, sf):
    return hits(spark, sf).select("post_no", "board")


@query(f"select post_no from posts where contains({JOINED}, ' with the ') and not list_contains({TOKENS}, 'idiot') or list_contains({TOKENS}, 'trash') or len([t for t in {TOKENS} if starts_with(t, 'loweis')]) > 0")
def filter_tsquery(spark, sf):
    return P.by_terms(posts(spark, sf), lambda t: t.follow("with", "the") & ~t.word("idiot") | t.word("trash") | t.prefix("loweis"), search.SIMPLE).select("post_no")


@query()
def filter_phrase_en(spark, sf):
    """Stemmed, with the stop word as distance; no engine here has the stemmer, so tests compare it with a plain version."""
    return P.by_phrase(posts(spark, sf), "attion to thanedble", search.ENGLISH).select("post_no", "board")


@query("select post_no, ts_utc from posts where board = 'de' and site = 'site0'")
def filter_board(spark, sf):
    return P.by_board(posts(spark, sf), "de", "site0").select("post_no", "ts_utc")


@query("select post_no, ts_utc from posts where ts_utc >= epoch(date '1996-03-01') and ts_utc < epoch(date '1998-10-01')")
def filter_time_range(spark, sf):
    return P.by_time(posts(spark, sf), "1996-03", "1998-09").select("post_no", "ts_utc")


@query("""select post_no, case when post_no % 5 = 4 then null else case post_no % 5
 when 0 then epoch(make_date(1990 + post_no % 30, 1, 1)) when 1 then epoch(make_date(1990 + post_no % 30, 1 + post_no % 12, 1))
 else epoch(make_date(1990 + post_no % 30, 1 + post_no % 12, 1 + post_no % 28)) end end::bigint as lower_bound,
 case when post_no % 5 = 4 then null else case post_no % 5 when 0 then epoch(make_date(1991 + post_no % 30, 1, 1))
 when 1 then epoch(make_date(1990 + post_no % 30, 1 + post_no % 12, 1) + interval 1 month)
 else epoch(make_date(1990 + post_no % 30, 1 + post_no % 12, 1 + post_no % 28) + interval 1 day) end end::bigint as upper_bound from posts""")
def parse_bound(spark, sf):
    n = F.col("post_no")
    y, m, d = (1990 + n % 30).cast("string"), F.lpad((1 + n % 12).cast("string"), 2, "0"), F.lpad((1 + n % 28).cast("string"), 2, "0")
    text = F.when(n % 5 == 0, y).when(n % 5 == 1, F.concat_ws("-", y, m)).when(n % 5 == 4, F.concat_ws("-", y, F.lit("13"), d)).otherwise(F.concat_ws("-", y, m, d))
    return posts(spark, sf).select("post_no", times.bound_column(text).alias("lower_bound"), times.bound_column(text, end=True).alias("upper_bound"))


@query("select year, sum(posts)::bigint as posts from stats where site like 'site_' and board like 'e%' and year is not null group by year", STATS)
def coverage_like(spark, sf):
    return A.coverage_by_year(stats(spark, sf), "site_", "e%")


@query("select post_no, board from posts where lower(board) not in ('en', 'fr')")
def exclude_boards(spark, sf):
    return P.without_boards(posts(spark, sf), ["EN", "fr"]).select("post_no", "board")


@query("select post_no, board from posts where board in ('en', 'es')")
def include_boards(spark, sf):
    return P.only_boards(posts(spark, sf), ["en", "es"]).select("post_no", "board")


@query("select post_no, source_rank from offers where subnum = 0", OFFERS)
def ghost_filter(spark, sf):
    return offers(spark, sf).filter(~P.is_ghost(F.col("subnum").cast("string"))).select("post_no", "source_rank")


@query("select post_no, case when post_no % 3 <> 0 and post_no > 0 then post_no end as number from posts")
def valid_post_no(spark, sf):
    text = F.when(F.col("post_no") % 3 == 0, F.concat(F.lit("x"), F.col("post_no").cast("string"))).otherwise(F.col("post_no").cast("string"))
    return posts(spark, sf).select("post_no", P.valid_number(text).alias("number"))


@query("select site, board, thread_no, post_no, is_op, ts_utc, subject, md5(body_text) as body_md5 from posts")
def project_hits(spark, sf):
    return posts(spark, sf).select("site", "board", "thread_no", "post_no", "is_op", "ts_utc", "subject", F.md5("body_text").alias("body_md5"))


@query("select post_no, board, ts_utc from hits order by ts_utc nulls last, post_no limit 25", POSTS + ", " + HITS)
def search_limit(spark, sf):
    return hits(spark, sf).select("post_no", "board", "ts_utc").orderBy(F.asc_nulls_last("ts_utc"), "post_no").limit(25)


@query("select count(*) as matches from hits", POSTS + ", " + HITS)
def search_total(spark, sf):
    return hits(spark, sf).agg(F.count("*").alias("matches"))


@query("""select post_no, '[' || coalesce(strftime(make_timestamp(nullif(ts_utc, 0) * 1000000), '%Y-%m-%d %H:%M'), '(no date)') || '] /' || board || '/' || post_no || ' (' || case when is_op then 'OP' else 'in ' || thread_no end || ')'
 || coalesce(' — “' || subject || '”', '') || chr(10) || '  ' || replace(body_text, chr(10), chr(10) || '  ') as rendered from hits""", POSTS + ", " + HITS)
def render_hits(spark, sf):
    from .store import render

    return hits(spark, sf).select("post_no", render().alias("rendered"))


@query("select post_no, to_json({'site': site, 'board': board, 'post_no': post_no, 'is_op': is_op})::varchar as line from posts")
def write_ndjson(spark, sf):
    return posts(spark, sf).select("post_no", F.to_json(F.struct("site", "board", "post_no", "is_op")).alias("line"))


@query(f"select post_no, {TOKENS} as tokens from posts")
def tokens_simple(spark, sf):
    return posts(spark, sf).select("post_no", search.tokens_simple(search.searched_text(F.col("subject"), F.col("body_text"))).alias("tokens"))


@query()
def tokens_en(spark, sf):
    return posts(spark, sf).select("post_no", search.tokens_english(search.searched_text(F.col("subject"), F.col("body_text"))).alias("tokens"))


@query(f"""select site, board, term, post_no, list(pos order by pos) as positions from (select site, board, post_no, unnest({TOKENS}) as term, generate_subscripts({TOKENS}, 1)::int as pos from posts) group by site, board, term, post_no""")
def inverted_index(spark, sf):
    return search.inverted_index(posts(spark, sf))


_CONDITION = "with <-> the & !idiot | trash | loweis:* & !(of | the <3> with)"
_CONDITION_SQL = (
    f"select post_no, board from (select *, {TOKENS} as t from posts) where contains({JOINED}, ' with the ') and not list_contains(t, 'idiot') or list_contains(t, 'trash')"
    " or len([x for x in t if starts_with(x, 'loweis')]) > 0 and not (list_contains(t, 'of') or len([i for i in range(1, len(t) - 2) if t[i] = 'the' and t[i+3] = 'with']) > 0)"
)


@query(_CONDITION_SQL)
def filter_condition(spark, sf):
    """A condition from text, over the texts."""
    return P.by_condition(posts(spark, sf), _CONDITION, search.SIMPLE).select("post_no", "board")


@query(_CONDITION_SQL)
def search_condition(spark, sf):
    """The same from the postings of its terms, in an index that three ingests have made."""
    p, index = posts(spark, sf), TermIndex(spark, f"{shared_folder(spark)}/terms-{uuid.uuid4().hex}")
    for k in range(3):
        index = index.add(p.filter(F.col("post_no") % 3 == k))
    return index.find(_CONDITION, p).select("post_no", "board")


@query("select post_no, board from hits", POSTS + ", " + HITS)
def search_index(spark, sf):
    """The phrase found through a stored index, which is built first."""
    p = posts(spark, sf)
    index = TermIndex(spark, f"{shared_folder(spark)}/terms-{uuid.uuid4().hex}").build(p)
    return index.phrase("with the").select("post_no", "board")


# ---- joins and dedup


@query("""select site, board, post_no, source_rank, md5(body_text) as body_md5 from offers
 qualify row_number() over (partition by site, board, post_no order by source_rank) = 1""", OFFERS)
def dedup_first_writer(spark, sf):
    return D.first_writer(offers(spark, sf)).select("site", "board", "post_no", "source_rank", F.md5("body_text").alias("body_md5"))


@query("""select source_rank, count(*) as read, count(*) filter (subnum <> 0) as ghost, count(*) filter (subnum = 0 and n = 1) as stored, count(*) filter (subnum = 0 and n > 1) as dup
 from (select *, row_number() over (partition by site, board, post_no, subnum order by source_rank) as n from offers) group by source_rank""", OFFERS)
def ingest_audit(spark, sf):
    return D.audit(offers(spark, sf))


@query("select p.post_no, t.board, t.thread_no from posts p join threads t on p.board = t.board and p.thread_no = t.thread_no", THREADS)
def join_posts_threads(spark, sf):
    from .views import BOARDS

    ref = F.col("thread_no") * 4 + F.array_position(F.array(*[F.lit(b) for b in BOARDS]), F.col("board")) - 1
    p = posts(spark, sf).select("post_no", ref.alias("thread_ref"))
    return D.with_threads(p, threads(spark, sf)).select("post_no", "board", "thread_no")


@query("select p.post_no from posts p where not exists (select 1 from threads t where p.board = t.board and p.thread_no = t.thread_no)", THREADS)
def posts_without_thread(spark, sf):
    from .views import BOARDS

    ref = F.col("thread_no") * 4 + F.array_position(F.array(*[F.lit(b) for b in BOARDS]), F.col("board")) - 1
    return D.without_thread(posts(spark, sf).select("post_no", ref.alias("thread_ref")), threads(spark, sf)).select("post_no")


@query("""select count(*) filter (t.site = 'site0') as joined, count(*) filter (t.site = 'site1') as "foreign", count(*) filter (t.site is null) as no_thread
 from posts p left join (select *, case when thread_no % 5 = 0 then 'site1' else 'site0' end as site from threads) t on p.board = t.board and p.thread_no = t.thread_no""", THREADS)
def thread_sites(spark, sf):
    from .views import BOARDS

    ref = F.col("thread_no") * 4 + F.array_position(F.array(*[F.lit(b) for b in BOARDS]), F.col("board")) - 1
    sites = threads(spark, sf).withColumn("site", F.when(F.col("thread_no") % 5 == 0, "site1").otherwise("site0"))
    return D.thread_audit(posts(spark, sf).select("post_no", ref.alias("thread_ref")), sites, "site0")


@query("select source_id, site, board, year, sum(posts)::bigint as posts, min(min_ts) as min_ts, max(max_ts) as max_ts from (select * from stats union all select * from stats where source_id < 10) group by all", STATS)
def stats_merge(spark, sf):
    s = stats(spark, sf)
    return D.merge_stats(s, s.filter("source_id < 10"))


@query("select 'src' || source_id as name, source_id as rank from (select distinct source_id from posts) where source_id >= 7")
def remaining_sources(spark, sf):
    wanted = posts(spark, sf).select(F.concat(F.lit("src"), F.col("source_id").cast("string")).alias("name"), F.col("source_id").alias("rank")).distinct()
    return D.remaining_sources(wanted, wanted.filter("rank < 7"))


# ---- aggregates

for _by, _fmt in (("day", "%Y-%m-%d"), ("month", "%Y-%m"), ("year", "%Y"), ("total", None)):
    _key = DATE.format(_fmt) if _fmt else "'total'"
    _f = (lambda by: lambda spark, sf: A.count_by(hits(spark, sf), by))(_by)
    _f.__name__ = f"count_by_{_by}"
    query(f"select {_key} as bucket, count(*) as posts from hits group by 1 order by 1 nulls last", POSTS + ", " + HITS)(_f)


@query("select * from stats", STATS)
def post_stats(spark, sf):
    return stats(spark, sf)


@query("select site, board, sum(posts)::bigint as posts, min(year) as first_year, max(year) as last_year from stats group by site, board", STATS)
def board_list(spark, sf):
    return A.board_list(stats(spark, sf))


@query("select year, sum(posts)::bigint as posts from stats where board = 'en' and site = 'site0' and year is not null group by year", STATS)
def board_years(spark, sf):
    return A.board_years(stats(spark, sf), "en", "site0")


@query("select count(*) > 0 as has_stats from stats", STATS)
def has_stats(spark, sf):
    return A.has_stats(stats(spark, sf))


@query(f"select site, board, count(*) as posts, count(distinct thread_no) as threads, min({DATE.format('%Y-%m-%d')}) as first_day, max({DATE.format('%Y-%m-%d')}) as last_day from posts group by site, board")
def list_boards(spark, sf):
    return A.list_boards(posts(spark, sf))


@query(f"select site, count(distinct board) as boards, count(*) as posts, min({DATE.format('%Y-%m-%d')}) as first_day, max({DATE.format('%Y-%m-%d')}) as last_day from posts group by site")
def list_sites(spark, sf):
    return A.list_sites(posts(spark, sf))


@query("select year, 'src' || source_id as name, sum(posts)::bigint as posts from stats where year is not null group by all", STATS)
def coverage_by_source(spark, sf):
    names = posts(spark, sf).select("source_id", F.col("source").alias("name")).distinct()
    return A.coverage_by_source(stats(spark, sf), names)


@query("select year, sum(posts)::bigint as posts from stats where year is not null group by year", STATS)
def coverage_by_year(spark, sf):
    return A.coverage_by_year(stats(spark, sf))


@query("select coalesce(sum(posts), 0)::bigint as posts, min(min_ts) as min_ts, max(max_ts) as max_ts from stats", STATS)
def corpus_totals(spark, sf):
    return A.corpus_totals(stats(spark, sf))


@query("select min(ts_utc) as min_ts, max(ts_utc) as max_ts from posts")
def timestamp_span(spark, sf):
    return A.timestamp_span(posts(spark, sf))


@query("select count(*) as posts, min(ts_utc) as min_ts, max(ts_utc) as max_ts from posts")
def heap_totals(spark, sf):
    return A.heap_totals(posts(spark, sf))


@query("select count(*) as posts, min(ts_utc) as min_ts, max(ts_utc) as max_ts from posts where board = 'fr'")
def board_span(spark, sf):
    return A.heap_totals(P.by_board(posts(spark, sf), "fr"))


@query(f"select source_id, {YEAR} as year, count(*) as posts from posts where ts_utc is not null group by all")
def posts_by_year_source(spark, sf):
    return A.by_year_and_source(posts(spark, sf))


@query(f"""select y.year, coalesce(c.posts, 0) as posts from (select unnest(range((select min({YEAR}) from posts where board = 'es'), (select max({YEAR}) + 1 from posts where board = 'es')))::int as year) y
 left join (select {YEAR} as year, count(*) as posts from posts where board = 'es' group by 1) c using (year)""")
def posts_by_year_board_filled(spark, sf):
    return A.board_years_filled(posts(spark, sf), "es")


@query("""select s.source_id, y.year, coalesce(c.posts, 0)::bigint as posts from (select distinct source_id from stats where year is not null) s
 cross join (select unnest(range((select min(year) from stats), (select max(year) + 1 from stats)))::int as year) y
 left join (select source_id, year, sum(posts) as posts from stats group by all) c on c.source_id = s.source_id and c.year = y.year""", STATS)
def coverage_grid(spark, sf):
    return A.coverage_grid(stats(spark, sf))


@query("select source_id, sum(posts)::bigint as posts from stats group by source_id", STATS)
def source_ranking(spark, sf):
    return A.source_ranking(stats(spark, sf))


@query("""select site, board, count(*) as posts, count(*) filter (is_op) as ops, count(*) filter (ts_utc is null) as undated, min(post_no) as min_post_no, max(post_no) as max_post_no,
 strftime(make_timestamp(min(ts_utc) * 1000000), '%Y-%m-%d %H:%M') as first_at, strftime(make_timestamp(max(ts_utc) * 1000000), '%Y-%m-%d %H:%M') as last_at from posts group by site, board""")
def survey_boards(spark, sf):
    return A.survey_boards(posts(spark, sf))


@query("select site, board, count(*) as posts, count(distinct post_no) as distinct_posts from offers group by site, board", OFFERS)
def survey_distinct(spark, sf):
    return A.survey_distinct(offers(spark, sf))


@query("""select sum(posts)::bigint as posts, sum(d)::bigint as distinct_posts, (sum(posts) - sum(d))::bigint as repeats, min(lo) as min_ts, max(hi) as max_ts
 from (select count(*) as posts, count(distinct post_no) as d, min(ts_utc) as lo, max(ts_utc) as hi from offers group by site, board)""", OFFERS)
def survey_totals(spark, sf):
    return A.survey_totals(offers(spark, sf))


@query(f"select coalesce({DATE.format('%Y-%m')}, '(undated)') as bucket, count(*) as posts from posts group by 1 union all select 'TOTAL', count(*) from posts")
def survey_buckets(spark, sf):
    return A.survey_buckets(posts(spark, sf))


@query(f"select site, board, {DATE.format('%Y-%m')} as month, count(*) as posts from posts where ts_utc is not null group by all")
def month_key(spark, sf):
    return A.months_of(posts(spark, sf))


@query("select board, count(*) as posts, count(*) filter (is_op) as ops, count(*) filter (ts_utc is null) as undated from posts group by rollup (board)")
def dry_run_report(spark, sf):
    return A.dry_run_report(posts(spark, sf))


@query("select board, sum(posts)::bigint as posts, min(min_ts) as min_ts, max(max_ts) as max_ts from stats group by rollup (board)", STATS)
def board_totals(spark, sf):
    return stats(spark, sf).rollup("board").agg(F.sum("posts").alias("posts"), F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"))


@query("""select board, thread_no as thread, last_modified, last from (select board, thread_no, max(ts_utc) as last_modified, max(post_no) as last from posts group by all)
 where last_modified is not null qualify row_number() over (partition by board order by last_modified desc, thread_no desc) = 1""")
def latest_post(spark, sf):
    return A.latest_post(posts(spark, sf))


@query(f"""select h.year, hits, t.posts, round(hits / t.posts * 100000, 2) as rate from (select {YEAR} as year, count(*) as hits from hits where ts_utc is not null group by 1) h
 left join (select {YEAR} as year, count(*) as posts from posts where ts_utc is not null group by 1) t using (year)""", POSTS + ", " + HITS)
def phrase_per_100k(spark, sf):
    return A.per_100k(hits(spark, sf), posts(spark, sf))


# ---- scalar functions


_STRIP = r"regexp_replace(regexp_replace(regexp_replace({}, '<br\s*/?>', chr(10), 'gi'), '<wbr\s*/?>', '', 'gi'), '<[^>]*>', '', 'g')"
_NAMED = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '&lt;', '<', 'gi'), '&gt;', '>', 'gi'), '&quot;', '\"', 'gi'), '&apos;', '''', 'gi'), '&nbsp;', ' ', 'gi'), '&amp;', '&', 'gi')"


@query("select page_id, md5(" + _NAMED.format(_STRIP.format("html")) + ") as text_md5 from pages", "unused as (select 1)")
def strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(texts.strip_html(F.col("html"))).alias("text_md5"))


@query(r"select page_id, md5(nullif(regexp_replace(" + _NAMED.format(r"regexp_replace(regexp_replace(html || '<span class=', '<[^>]*>', '', 'g'), '<[^>]*$', '')") + r", '[\s ]+$', ''), '')) as text_md5 from pages", "unused as (select 1)")
def clean_body_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(texts.clean_body_text(F.concat("html", F.lit("<span class=")))).alias("text_md5"))


@query("select page_id, md5(" + _NAMED.format("html") + ") as text_md5 from pages", "unused as (select 1)")
def decode_entities(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(texts.decode_entities(F.col("html"))).alias("text_md5"))


@query("select post_no, md5(body_text) as clean_md5 from posts")
def strip_nulls(spark, sf):
    dirty = F.concat(F.substr("body_text", F.lit(1), F.lit(5)), F.lit("\x00"), F.substr("body_text", F.lit(6)))
    return posts(spark, sf).select("post_no", F.md5(texts.strip_nulls(dirty)).alias("clean_md5"))


@query("select post_no, md5(body_text) as body_md5 from posts")
def md5_text(spark, sf):
    return posts(spark, sf).select("post_no", F.md5("body_text").alias("body_md5"))


@query()
def levenshtein_text(spark, sf):
    p = posts(spark, sf).select("post_no", F.col("body_text").alias("t"))
    q = p.select((F.col("post_no") - 1).alias("post_no"), F.col("t").alias("u"))
    return p.join(q, "post_no").select("post_no", texts.levenshtein("t", "u").alias("distance"))


_SECONDS = "epoch(make_timestamp(2003 + post_no % 15, 1 + post_no % 12, 1 + post_no % 28, post_no % 24, post_no % 60, 0))::bigint"
_WALL = f"""walls as (select post_no, {_SECONDS} as wall, make_date(2003 + post_no % 15, 1 + post_no % 12, 1 + post_no % 28) as day, 2003 + post_no % 15 as y from posts),
 zones as (select *, case when y >= 2007 then make_date(y, 3, 1) + ((7 - dayofweek(make_date(y, 3, 1))) % 7)::int + 7 else make_date(y, 4, 1) + ((7 - dayofweek(make_date(y, 4, 1))) % 7)::int end as b,
 case when y >= 2007 then make_date(y, 11, 1) + ((7 - dayofweek(make_date(y, 11, 1))) % 7)::int else make_date(y, 10, 31) - dayofweek(make_date(y, 10, 31))::int end as e from walls),
 utc as (select *, wall + case when wall >= epoch(b) + 7200 and wall < epoch(e) + 7200 then 14400 else 18000 end as ts from zones)"""


def _wall_parts():
    n = F.col("post_no")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return (2003 + n % 15).cast("string"), two(1 + n % 12), two(1 + n % 28), two(n % 24), two(n % 60)


@query("select post_no, ts from utc", POSTS + ", " + _WALL)
def ny_wall_to_utc(spark, sf):
    y, m, d, h, mi = _wall_parts()
    wall = times.day_seconds(F.to_date(F.concat_ws("-", y, m, d))) + h.cast("long") * 3600 + mi.cast("long") * 60
    return posts(spark, sf).select("post_no", times.ny_wall_to_utc(wall).alias("ts"))


@query("select post_no, case when post_no % 9 <> 0 then ts end as ts from utc", POSTS + ", " + _WALL)
def parse_mysql_datetime(spark, sf):
    y, m, d, h, mi = _wall_parts()
    text = F.when(F.col("post_no") % 9 == 0, F.lit("0000-00-00 00:00:00")).otherwise(F.concat(y, F.lit("-"), m, F.lit("-"), d, F.lit(" "), h, F.lit(":"), mi, F.lit(":00")))
    return posts(spark, sf).select("post_no", times.parse_mysql_datetime(text).alias("ts"))


@query("select post_no, ts from utc", POSTS + ", " + _WALL)
def parse_display_date(spark, sf):
    y, m, d, h, mi = _wall_parts()
    text = F.concat(m, F.lit("/"), d, F.lit("/"), F.substr(y, F.lit(3)), F.lit("(Mon)"), h, F.lit(":"), mi)
    return posts(spark, sf).select("post_no", times.parse_display_date(text).alias("ts"))


@query("select post_no, case when post_no % 3 = 0 then 'pic' || post_no || '.jpg' else 'srv' || post_no || '.png' end as name from posts")
def file_name_from(spark, sf):
    n = F.col("post_no").cast("string")
    info = F.when(F.col("post_no") % 3 == 0, F.concat(F.lit("File: srv"), n, F.lit(".png (12 KB, 640x480, pic"), n, F.lit(".jpg)"))).otherwise(F.concat(F.lit("File: srv"), n, F.lit(".png (12 KB, 640x480)")))
    return posts(spark, sf).select("post_no", texts.file_name_from(info).alias("name"))


@query(r"""select page_id, case when h = 'example.com' or h like '%.example.com' then 'main' else nullif(h, '') end as site, nullif(regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]+)', 1), '') as board
 from (select *, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) as h from pages)""", "unused as (select 1)")
def url_board_site(spark, sf):
    site, board = texts.url_site_board(F.col("url"), "example.com", "main")
    return table(spark, sf, "pages").select("page_id", site.alias("site"), board.alias("board"))


@query(r"select page_id, regexp_replace(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '/+$', ''), '[^A-Za-z0-9._-]+', '_', 'g') || '.html' as name from pages", "unused as (select 1)")
def warc_slug(spark, sf):
    return table(spark, sf, "pages").select("page_id", texts.url_slug(F.col("url")).alias("name"))


@query("select post_no, case post_no % 3 when 0 then post_no end as asserted, case post_no % 3 when 2 then null else post_no end as nested, case post_no % 3 when 2 then post_no end as flat from posts")
def thread_from_name(spark, sf):
    n = F.col("post_no").cast("string")
    name = F.when(F.col("post_no") % 3 == 0, F.concat(n, F.lit(".html"))).when(F.col("post_no") % 3 == 1, F.concat(n, F.lit("_old.html"))).otherwise(F.concat(F.lit("en_"), n, F.lit(".html")))
    return posts(spark, sf).select("post_no", texts.thread_from_name(name).alias("asserted"), texts.nested_thread(name).alias("nested"), texts.flat_identity(name)[1].alias("flat"))


@query("select post_no, case when post_no % 4 = 3 then null else board end as board, case when post_no % 4 = 3 then null else post_no || '.html' end as file from posts")
def stage_native_identity(spark, sf):
    n, b, k = F.col("post_no").cast("string"), F.col("board"), F.col("post_no") % 4
    name = F.when(k == 0, F.concat(b, F.lit("_"), n, F.lit(".html"))).when(k == 1, F.concat(b, F.lit("/"), n)).when(k == 2, F.concat(b, F.lit("/res/"), n, F.lit(".html"))).otherwise("index.html")
    board, file = texts.native_identity(name)
    return posts(spark, sf).select("post_no", board.alias("board"), file.alias("file"))


@query("select post_no, case when post_no % 2 = 0 then board end as title_board from posts")
def title_board(spark, sf):
    title = F.when(F.col("post_no") % 2 == 0, F.concat(F.lit("  /"), F.col("board"), F.lit("/  -\n Things"))).otherwise("Things")
    return posts(spark, sf).select("post_no", texts.title_board(title).alias("title_board"))


@query("select post_no, case when post_no % 3 = 0 then null else -post_no end as number, nullif(case when post_no % 2 = 0 then '' else board end, '') as name from posts")
def coerce_num_str(spark, sf):
    raw = F.when(F.col("post_no") % 3 == 0, F.lit("n/a")).otherwise((-F.col("post_no")).cast("string"))
    return posts(spark, sf).select("post_no", texts.number_or_null(raw).alias("number"), texts.text_or_null(F.when(F.col("post_no") % 2 == 0, "").otherwise(F.col("board"))).alias("name"))


# ---- histogram


@query("select source_id, site, board, cast(floor(ts_utc / 2592000) as bigint) as bucket, min(ts_utc) as first_ts, max(ts_utc) as last_ts, count(*) as posts, min(post_no) as low_no, max(post_no) as high_no from posts where ts_utc is not null group by all")
def post_dates_fixed(spark, sf):
    return H.fixed(posts(spark, sf), 30 * 86400)


@query("select source_id, site, board, cast(floor(ts_utc / 5184000) as bigint) as bucket, min(ts_utc) as first_ts, max(ts_utc) as last_ts, count(*) as posts, min(post_no) as low_no, max(post_no) as high_no from posts where ts_utc is not null group by all")
def post_dates_coarsen(spark, sf):
    return H.coarsen(H.fixed(posts(spark, sf), 30 * 86400), 30 * 86400, 60 * 86400)


_WIDTHS = EVENT_POSTS + """, wide as (select site, board, cast(pow(2, min(k)) as bigint) as width from (select site, board, k, count(distinct floor(ts_utc / pow(2, k))) as n
 from event_posts, range(0, 33) r(k) group by all) where n <= 100 group by site, board)"""
_BUCKETS = "cast(floor(ts_utc / width) as bigint) as bucket, min(ts_utc) as first_ts, max(ts_utc) as last_ts, count(*) as posts, min(post_no) as low_no, max(post_no) as high_no"


@query(f"select site, board, width, {_BUCKETS} from event_posts join wide using (site, board) group by all", _WIDTHS)
def post_dates_adaptive(spark, sf):
    return H.adaptive(event_posts(spark, sf), 50, series=["site", "board"])


@query(f"select site, board, width, {_BUCKETS} from event_posts cross join (select max(width) as width from wide) group by all", _WIDTHS)
def post_dates_multi(spark, sf):
    return H.common(event_posts(spark, sf), 50, series=["site", "board"])


@query("select distinct source_id, site, board, ts_utc, unnest([low_no, high_no]) as post_no from (select source_id, site, board, min(ts_utc) as ts_utc, min(post_no) as low_no, max(post_no) as high_no from posts where ts_utc is not null group by source_id, site, board, floor(ts_utc / 2592000))")
def post_dates_points(spark, sf):
    return H.points(H.fixed(posts(spark, sf), 30 * 86400))


# ---- presence


@query("select source_id, board, count(distinct post_no) as present, count(*) as rows, max(post_no) as max_no from offers group by source_id, board", OFFERS)
def presence_bitmap(spark, sf):
    return B.bitmap_counts(B.bitmaps(offers(spark, sf), ["source_id", "board"]), ["source_id", "board"])


@query("select w.board, w.post_no, exists (select 1 from posts p where p.board = w.board and p.post_no = w.post_no) as present from (select board, post_no + 1 as post_no from posts) w")
def has_post(spark, sf):
    p = posts(spark, sf)
    return B.has_post(p.select("board", (F.col("post_no") + 1).alias("post_no")), p)


@query("select board, max(post_no) as last from posts group by board")
def board_last(spark, sf):
    return B.board_last(posts(spark, sf))


_GRID = "grid as (select board, last, cast(ceil(ceil(sqrt(last)) / 16) * 16 as bigint) as w from (select board, max(post_no) as last from posts group by board))"


@query("select board, last, w as row_width, cast(ceil(last / w) as bigint) as grid_rows from grid", POSTS + ", " + _GRID)
def map_layout(spark, sf):
    return B.layout(B.board_last(posts(spark, sf)), 16)


@query("select source_id, p.board, count(distinct post_no) as present, max(last) as cells from posts p join (select board, max(post_no) as last from posts group by board) l on l.board = p.board where post_no between 1 and last group by source_id, p.board")
def presence_ratio(spark, sf):
    p = posts(spark, sf)
    return B.ratio(p, B.board_last(p))


_PYRAMID = f"""{_GRID}, cells as (select distinct g.board, last, w, post_no - 1 as c from posts p join grid g on g.board = p.board where post_no between 1 and last),
 every as (select board, w, unnest(range(0, last)) as c from grid),
 blocks as (select board, k, cast(floor(floor(c / w) / k) as bigint) as y, cast(floor((c % w) / k) as bigint) as x, count(*) as present from cells, (values (2), (4), (8)) v(k) group by all),
 ranges as (select board, k, cast(floor(floor(c / w) / k) as bigint) as y, cast(floor((c % w) / k) as bigint) as x, count(*) as cells from every, (values (2), (4), (8)) v(k) group by all),
 pyramid as (select board, k, y, x, present, cells, cast(greatest(1, floor(present * 255 / cells + 0.5)) as int) as opacity from blocks join ranges using (board, k, y, x))"""


@query("select * from pyramid", POSTS + ", " + _PYRAMID)
def presence_pyramid(spark, sf):
    p = posts(spark, sf)
    return B.pyramid(p, B.layout(B.board_last(p), 16), [2, 4, 8])


@query("select board, k, cast(floor(y / 4) as bigint) as tile_y, cast(floor(x / 4) as bigint) as tile_x, count(*) as pixels from pyramid group by all", POSTS + ", " + _PYRAMID)
def tiles_written(spark, sf):
    return B.tiles(presence_pyramid(spark, sf), 4)


_VIEWS = "maps as (select source_id, board, max(post_no) // 100 as last, count(distinct post_no) as present from posts group by all), votes as (select board, last, count(*) as n from maps group by all), best as (select board, last from votes qualify row_number() over (partition by board order by n desc, last desc) = 1)"


@query("select m.board, m.last, source_id, present, row_number() over (partition by m.board order by present desc, source_id)::int as place from maps m join best b on b.board = m.board and b.last = m.last", POSTS + ", " + _VIEWS)
def board_views(spark, sf):
    maps = posts(spark, sf).groupBy("source_id", "board").agg(F.floor(F.max("post_no") / 100).alias("last"), F.count_distinct("post_no").alias("present"))
    return B.board_views(maps)


@query("select source_id, p.board, count(distinct post_no) as present, max(last) as cells from posts p join (select board, max(post_no) // 2 as last from posts group by board) l on l.board = p.board where post_no between 1 and last group by source_id, p.board")
def presence_vs_latest(spark, sf):
    p = posts(spark, sf)
    return B.ratio(p, p.groupBy("board").agg(F.floor(F.max("post_no") / 2).alias("last")))


# ---- timeline, headers, pages


@query("select distinct replace(slug, '/', '') as slug from timeline where regexp_matches(replace(slug, '/', ''), '^[a-z0-9]+$')", TIMELINE_SQL)
def board_slugs(spark, sf):
    return L.slugs(timeline(spark, sf))


_PAIRS = TIMELINE_SQL + """, pairs as (select c.slug, try_cast(c.date as date) as made, min(try_cast(r.date as date)) as gone from (select * from timeline where type = 'created' and length(date) = 10) c
 join (select * from timeline where type = 'removed' and length(date) = 10) r on r.slug = c.slug and try_cast(r.date as date) - try_cast(c.date as date) between 1 and 7 where month(try_cast(c.date as date)) = 4 and day(try_cast(c.date as date)) in (1, 2) group by c.slug, c.date)"""
_AT = "(year(d) + (d - make_date(year(d), 1, 1)) / 365.25)"


@query("select slug, made, gone from pairs", _PAIRS)
def april_fools_pairs(spark, sf):
    return L.fools_pairs(timeline(spark, sf))


@query(f"""select type, slug, date, round({_AT}, 6) as "at" from (select *, (case when length(date) = 7 then date || '-01' else date end)::date as d from
 (select type, slug, date from timeline t where date is not null and not exists (select 1 from pairs p where p.slug = t.slug and t.date in (p.made::varchar, p.gone::varchar))
 union all select 'fools', count(*) || ' boards', min(made)::varchar from pairs group by year(made)))""", _PAIRS)
def timeline_events(spark, sf):
    return L.events_with_fools(timeline(spark, sf))


@query(f"""select since, y as upto from (select y, lag(y) over (order by y) as since from (select distinct round({_AT}, 6) as y from (select (case when length(date) = 7 then date || '-01' else date end)::date as d from timeline where date is not null) union select 2026.5::double)) where y - since > 2.0""", TIMELINE_SQL)
def timeline_gaps(spark, sf):
    return L.gaps(timeline(spark, sf), 2.0, 2026.5)


_DAY = "make_date(2004 + (event_id % 15)::int, 1 + (event_id % 12)::int, 1 + (event_id % 28)::int)"


@query(f"""select event_id, case when event_id % 7 in (1, 2) or event_id = 0 then null else event_id end as post_no,
 case when event_id % 7 in (1, 2) or event_id = 0 then null else strftime({_DAY}, '%m/%d/%y(%a)') || lpad((event_id % 24)::varchar, 2, '0') || ':' || lpad((event_id % 60)::varchar, 2, '0') end as date from events""", "unused as (select 1)")
def ocr_header(spark, sf):
    n = F.col("event_id")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    day = F.make_date((2004 + n % 15).cast("int"), (1 + n % 12).cast("int"), (1 + n % 28).cast("int"))
    names = F.array(*[F.lit(x) for x in ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")])
    real = F.get(names, F.dayofweek(day) - 1)
    other = F.get(names, F.dayofweek(day) % 7)
    weekday = F.when(n % 7 == 0, "Xyz").when(n % 7 == 1, other).otherwise(real)
    hour = F.when(n % 7 == 2, "25").otherwise(two(n % 24))
    line = F.concat(F.lit("Anonymous "), F.date_format(day, "MM/dd/yy"), F.lit("("), weekday, F.lit(")"), hour, F.lit(":"), two(n % 60), F.lit(" No."), n.cast("string"))
    got = O.read_header(line)
    return table(spark, sf, "events").select("event_id", got["post_no"].alias("post_no"), got["date"].alias("date"))


@query(r"""select path, dir_board, board, case when copy > 1 then 'remove' when snap > 0 then 'snapshot' when dir_board <> board then 'move' else 'keep' end as action,
 case when copy > 1 then null when snap > 0 then name || '.snap' || snap else name end as target
 from (select *, row_number() over (partition by board, name, copy = 1 order by h, path) - 1 as snap from (select *, row_number() over (partition by board, name, digest order by h, path) as copy from placed))""",
       "saved as (select 'page' || page_id as path, case when page_id % 3 = 0 then 'en' else 'de' end as dir_board, (page_id % 40) || '.html' as name, replace(html, 'href=\"/', 'href=\"/' || case when page_id % 5 < 3 then 'en' else 'de' end || '/') || case when page_id % 2 = 0 then '' else 'x' end as html from pages)"
       + r""", links as (select path, lower(unnest(l)) as item, generate_subscripts(l, 1) as pos from (select path, regexp_extract_all(html, 'href="[^"]*?/([A-Za-z0-9]+)/', 1) as l from saved)),
 best as (select path, item from (select path, item, count(*) as n, min(pos) as first from links group by all) qualify row_number() over (partition by path order by n desc, first) = 1),
 placed as (select *, case when dir_board = board then 0 else 1 end as h, sha1(html) as digest from (select p.path, p.dir_board, p.name, p.html, coalesce(m.item, p.dir_board) as board from saved p left join best m using (path)))""")
def reconcile_boards(spark, sf):
    n = F.col("page_id")
    board = F.when(n % 5 < 3, "en").otherwise("de")
    html = F.concat(F.replace(F.col("html"), F.lit('href="/'), F.concat(F.lit('href="/'), board, F.lit("/"))), F.when(n % 2 == 0, "").otherwise("x"))
    saved = table(spark, sf, "pages").select(F.concat(F.lit("page"), n.cast("string")).alias("path"), F.when(n % 3 == 0, "en").otherwise("de").alias("dir_board"), F.concat((n % 40).cast("string"), F.lit(".html")).alias("name"), html.alias("html"))
    return G.reconcile(saved)


# ---- sources; numbers are shifted by a block, for a thread pointer of 0 means the post itself


def shifted(spark: SparkSession, sf: str) -> DataFrame:
    return posts(spark, sf).withColumns({"post_no": F.col("post_no") + 8, "thread_no": F.col("thread_no") + 8})


SHIFTED = POSTS + ", shifted as (select * replace (post_no + 8 as post_no, thread_no + 8 as thread_no) from posts)"


@query("select site, board, thread_no, post_no, is_op, ts_utc, nullif(subject, '') as subject, nullif(body_text, '') as body_text from shifted where post_no % 29 <> 0", SHIFTED)
def scan_ndjson(spark, sf):
    p = shifted(spark, sf)
    ghost = F.when(F.col("post_no") % 29 == 0, 1).otherwise(0)
    line = F.to_json(F.struct("site", "board", F.col("post_no").alias("num"), ghost.alias("subnum"), F.when(F.col("is_op"), 0).otherwise(F.col("thread_no")).alias("thread_num"), F.col("ts_utc").alias("timestamp"), F.col("subject").alias("title"), F.col("body_text").alias("comment")))
    return J.stored(J.staged_posts(p.select(line.alias("line")))).select("site", "board", "thread_no", "post_no", "is_op", "ts_utc", "subject", "body_text")


@query("select board, thread_no, post_no, is_op, ts_utc from shifted", SHIFTED)
def stage_api_threads(spark, sf):
    p = shifted(spark, sf)
    one = F.struct(F.col("post_no").alias("no"), F.when(F.col("is_op"), 0).otherwise(F.col("thread_no")).alias("resto"), F.col("ts_utc").alias("time"), F.col("subject").alias("sub"))
    files = p.groupBy("board", "thread_no").agg(F.to_json(F.struct(F.collect_list(one).alias("posts"))).alias("text"))
    return J.api_posts(files, F.col("board"), F.col("thread_no")).select("board", "thread_no", "post_no", "is_op", "ts_utc")


@query("select board, thread_no, post_no, is_op, ts_utc, md5(body_text) as media_md5 from shifted where board <> 'fr'", SHIFTED)
def stage_asagi_export(spark, sf):
    text = lambda c: F.col(c).cast("string")
    board = F.when(F.col("board") != "fr", F.struct(F.lit("").alias("name"), F.col("board").alias("shortname")))
    line = F.to_json(F.struct(text("post_no").alias("num"), F.lit("0").alias("subnum"), text("thread_no").alias("thread_num"), text("ts_utc").alias("timestamp"), board.alias("board"), F.struct(F.lit("").alias("media_filename"), F.md5("body_text").alias("media_hash")).alias("media")))
    out = J.stored(J.exported_posts(shifted(spark, sf).select(line.alias("line"))))
    return out.select("board", "thread_no", "post_no", "is_op", "ts_utc", "media_md5")


@query("select board, thread_no, post_no, is_op, post_no % 7 = 0 as deleted, post_no % 11 = 0 as mismatch from shifted", SHIFTED)
def stage_hayden(spark, sf):
    n = F.col("post_no")
    obj = F.struct(n.cast("string").alias("num"), F.when(n % 11 == 0, F.col("thread_no") + 1).otherwise(F.col("thread_no")).cast("string").alias("thread_num"), F.when(n % 7 == 0, "1").otherwise("0").alias("deleted"))
    one = F.struct(obj.alias("OriginalObject"))
    files = shifted(spark, sf).groupBy("board", "thread_no").agg(F.to_json(F.struct(F.struct(F.collect_list(one).alias("Posts")).alias("Thread"))).alias("text"))
    return J.scraped_posts(files, F.col("board"), F.col("thread_no")).select("board", "thread_no", "post_no", "is_op", "deleted", "mismatch")


@query("select post_no, 'b' || board as table_name, body_text from shifted", SHIFTED)
def parse_mysql_tuple(spark, sf):
    quoted = F.replace(F.replace(F.replace("body_text", F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("\n"), F.lit("\\n"))
    body = F.coalesce(F.concat(F.lit("'"), quoted, F.lit("'")), F.lit("NULL"))
    statement = F.concat(F.lit("INSERT INTO `b"), F.col("board"), F.lit("` (`num`, `comment`) VALUES (-1, 'a),(b'), ("), F.col("post_no").cast("string"), F.lit(", "), body, F.lit(");"))
    table_name, _, values = M.insert_parts(statement)
    rows = shifted(spark, sf).select(table_name.alias("table_name"), F.explode(M.parse_tuples(values)).alias("v")).filter(F.col("v")[0] != "-1")
    return rows.select(F.col("v")[0].cast("long").alias("post_no"), "table_name", F.col("v")[1].alias("body_text"))


@query(r"select post_no, md5(regexp_replace(replace(coalesce(body_text, ''), chr(10), chr(13)) || chr(8232) || 'x', '\r$', '')) as line_md5 from posts")
def scan_lines(spark, sf):
    """Lines that hold carriage returns and line separators, written and read back."""
    body = F.concat(F.translate(F.coalesce("body_text", F.lit("")), "\n", "\r"), F.lit("\u2028x"))
    path = text_files(posts(spark, sf).select(F.concat(F.col("post_no").cast("string"), F.lit("\t"), body, F.lit("\r"))), "lines")
    at = F.locate("\t", F.col("line"))
    return J.read_lines(spark, path).select(F.substr("line", F.lit(1), at - 1).cast("long").alias("post_no"), F.md5(F.substr("line", at + 1)).alias("line_md5"))


def _walls(spark, sf):
    """Shifted posts with a New York wall time for each."""
    y, m, d, h, mi = _wall_parts()
    wall = times.day_seconds(F.to_date(F.concat_ws("-", y, m, d))) + h.cast("long") * 3600 + mi.cast("long") * 60
    return posts(spark, sf).withColumn("wall", wall).withColumns({"post_no": F.col("post_no") + 8, "thread_no": F.col("thread_no") + 8})


_SHIFTED_UTC = SHIFTED + ", " + _WALL


def _dump(spark, sf):
    """The path of a dump with literal line feeds, quoted statements, tables of deleted posts, ghosts, thread pointers of 0 and a table without posts."""
    n, text = F.col("post_no"), lambda c: F.col(c).cast("string")
    body = F.concat(F.coalesce("body_text", F.lit("")), F.when(n % 13 == 0, "\nINSERT INTO `x` VALUES (1,'a'),(").otherwise(""))
    quoted = F.replace(F.replace(body, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    name = F.concat("board", F.when(n % 5 == 0, "_deleted").otherwise(""))
    create = F.concat(F.lit("CREATE TABLE IF NOT EXISTS `"), name, F.lit("` (\n  `num` int,\n  `subnum` int,\n  `thread_num` int,\n  `timestamp` int,\n  `comment` text\n) x;\nCREATE TABLE `staff` (\n  `id` int\n);\nINSERT INTO `staff` VALUES (1),(2);\n"))
    values = F.concat_ws(", ", text("post_no"), F.when(n % 29 == 0, "1").otherwise("0"), F.when(F.col("is_op"), "0").otherwise(text("thread_no")), text("wall"), F.concat(F.lit("'"), quoted, F.lit("'")))
    return text_files(_walls(spark, sf).select(F.concat(create, F.lit("INSERT INTO `"), name, F.lit("` VALUES ("), values, F.lit(");"))), "dump")


@query("""select board, thread_no, s.post_no, is_op, u.ts as ts_utc, md5(coalesce(body_text, '') || case when s.post_no % 13 = 0 then chr(10) || 'INSERT INTO `x` VALUES (1,''a''),(' else '' end) as body_md5
 from shifted s join utc u on u.post_no = s.post_no - 8 where s.post_no % 29 <> 0""", _SHIFTED_UTC)
def scan_sqldump(spark, sf):
    return M.stored(M.read_dump(spark, _dump(spark, sf))).select("board", "thread_no", "post_no", "is_op", "ts_utc", F.md5("body_text").alias("body_md5"))


@query("""select board, thread_no, s.post_no, is_op, u.ts as ts_utc, md5(coalesce(body_text, '') || case when s.post_no % 13 = 0 then chr(10) || 'INSERT INTO `x` VALUES (1,''a''),(' else '' end) as body_md5
 from shifted s join utc u on u.post_no = s.post_no - 8 where s.post_no % 29 <> 0 and board in ('de', 'fr')""", _SHIFTED_UTC)
def scan_sqldump_boards(spark, sf):
    """Two boards of the dump; INSERTs of others are left out by their heads, before their tuples are parsed."""
    return M.stored(M.read_dump(spark, _dump(spark, sf), boards=["de", "fr"])).select("board", "thread_no", "post_no", "is_op", "ts_utc", F.md5("body_text").alias("body_md5"))


@query("""select * from (values ('de', ['num', 'subnum', 'thread_num', 'timestamp', 'media_filename', 'media_orig', 'comment'], true), ('staff', ['id', 'media_filename'], false)) t(board, names, posts)""", "unused as (select 1)")
def normalize_columns(spark, sf):
    """Declared columns of the older schema under their newer names."""
    tables = spark.createDataFrame([("de", ["num", "subnum", "parent", "timestamp", "media", "media_filename", "comment"]), ("staff", ["id", "media"])], "board string, declared array<string>")
    names = M.normal_columns(F.col("declared"))
    return tables.select("board", names.alias("names"), M.holds_posts(names).alias("posts"))


_CLEAN = r"nullif(regexp_replace(regexp_replace(regexp_replace(body_text, '<[^>]*>', '', 'g'), '<[^>]*$', ''), '[\s ]+$', ''), '')"


def _escaped(text):
    return F.replace(F.replace(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("\n"), F.lit("<br>"))


def _thread_pages(rows, post, head="", tail=""):
    """A page for each thread, on one of three boards: (file, board, page), its posts in order."""
    each = rows.groupBy("thread_no").agg(F.sort_array(F.collect_list(F.struct("post_no", post.alias("html")))).alias("posts"))
    board, page = F.concat(F.lit("b"), (F.floor(F.col("thread_no") / 8) % 3).cast("string")), F.concat(F.lit(head), F.array_join(F.transform("posts", lambda p: p["html"]), "\n"), F.lit(tail))
    return each.select(F.concat(F.lit("/"), board, F.lit("/"), board, F.lit("_"), F.col("thread_no").cast("string"), F.lit(".html")).alias("file"), board.alias("board"), page.alias("page"))


_PLACED = "'b' || thread_no // 8 % 3 as board"


@query(f"select {_PLACED}, thread_no, post_no, is_op, ts_utc, md5({_CLEAN}) as body_md5 from shifted", SHIFTED)
def scan_html_native(spark, sf):
    n = F.col("post_no").cast("string")
    stamp = F.coalesce(F.concat(F.lit('<span class="dateTime" data-utc="'), F.col("ts_utc").cast("string"), F.lit('">x</span>')), F.lit(""))
    post = F.concat(F.lit('<div class="postContainer '), F.when(F.col("is_op"), "opContainer").otherwise("replyContainer"), F.lit('" id="pc'), n, F.lit('"><div class="postInfoM mobile"><span class="name">M</span></div><div class="postInfo desktop"><span class="name">Anon</span>'), stamp, F.lit('</div><blockquote class="postMessage">'), _escaped(F.col("body_text")), F.lit('<span class="abbr">Comment too long.</span></blockquote></div>'))
    return X.native_posts(_thread_pages(shifted(spark, sf), post, "<html><body>", "</body></html>")).select("board", "thread_no", "post_no", "is_op", "ts_utc", F.md5("body_text").alias("body_md5"))


@query(f"select * from (select {_PLACED}, thread_no, post_no, is_op, ts_utc, md5({_CLEAN}) as body_md5 from shifted) where board in ('b0', 'b2')", SHIFTED)
def scan_saved_pages(spark, sf):
    """Pages saved as one file each in a folder for each board; those of two boards are read."""
    n, text = F.col("post_no").cast("string"), F.col("body_text")
    stamp = F.coalesce(F.concat(F.lit('<span class="dateTime" data-utc="'), F.col("ts_utc").cast("string"), F.lit('">x</span>')), F.lit(""))
    post = F.concat(F.lit('<div class="postContainer '), F.when(F.col("is_op"), "opContainer").otherwise("replyContainer"), F.lit('" id="pc'), n, F.lit('"><div class="postInfo desktop"><span class="name">Anon</span>'), stamp, F.lit('</div><blockquote class="postMessage">'), _escaped(text), F.lit("</blockquote></div>"))
    pages = _thread_pages(shifted(spark, sf), post, "<html><body>", "</body></html>")
    path = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    W.extract_pages(pages.select(F.col("file").alias("uri"), F.lit("").alias("date"), F.substr("file", F.lit(2)).alias("name"), F.encode("page", "UTF-8").alias("body")), path)
    saved_pages.register(spark)
    read = spark.read.format("saved_pages").option("path", path).load().filter(F.col("board").isin("b0", "b2"))
    return X.native_posts(read).select("board", "thread_no", "post_no", "is_op", "ts_utc", F.md5("body_text").alias("body_md5"))


@query(f"select {_PLACED}, thread_no, s.post_no, is_op, u.ts as ts_utc, md5({_CLEAN}) as body_md5, 'pic' || s.post_no || '.jpg' as media_filename from shifted s join utc u on u.post_no = s.post_no - 8", _SHIFTED_UTC)
def scan_html_legacy(spark, sf):
    """Both hand-made templates: every other thread in one, the rest in the other."""
    rows = _walls(spark, sf)
    n, day = F.col("post_no").cast("string"), times.utc_date(F.col("wall"))
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    of_day = F.pmod("wall", F.lit(86400))
    date = F.concat(F.date_format(day, "MM/dd/yy"), F.lit("(Mon)"), two(of_day / 3600), F.lit(":"), two(of_day % 3600 / 60))
    file = F.concat(F.lit("File :99"), n, F.lit(".jpg-(51 KB, 287x700, pic"), n, F.lit(".jpg)"))
    body = _escaped(F.col("body_text"))
    later = F.concat(F.lit('<div class="post"><span class="post_no">'), n, F.lit('</span><span class="post_now">'), date, F.lit('</span><span class="post_filename">pic'), n, F.lit('.jpg</span><div class="post_com">'), body, F.lit("</div></div>"))
    opening = F.concat(F.lit('<span class="filesize">'), file, F.lit('</span><span class="postername">A</span> '), date, F.lit(' <span id="nothread'), n, F.lit('">No.</span><blockquote>'), body, F.lit("</blockquote>"))
    reply = F.concat(F.lit('<table><tr><td class="reply" id="'), n, F.lit('"><span class="commentpostername">A</span> '), date, F.lit('<span class="filesize">'), file, F.lit("</span><blockquote>"), body, F.lit("</blockquote></td></tr></table>"))
    first = F.col("thread_no") % 16 == 0
    pages = _thread_pages(rows.filter(first), later, "<html><body>", "</body></html>").unionByName(_thread_pages(rows.filter(~first), F.when(F.col("is_op"), opening).otherwise(reply), "<html><body>", "</body></html>"))
    return X.legacy_posts(pages).select("board", "thread_no", "post_no", "is_op", "ts_utc", F.md5("body_text").alias("body_md5"), "media_filename")


@query(f"select {_PLACED}, count(*) as posts, count(*) filter (is_op) as ops from shifted group by 1", SHIFTED)
def stage_html(spark, sf):
    """Posts of saved pages written as staged lines and read back."""
    n = F.col("post_no").cast("string")
    post = F.concat(F.lit('<div class="post"><span class="post_no">'), n, F.lit('</span><div class="post_com">'), _escaped(F.col("body_text")), F.lit("</div></div>"))
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    J.stage(X.legacy_posts(_thread_pages(shifted(spark, sf), post)), path)
    return J.stored(J.read_staged_folders(spark, path)).groupBy("board").agg(F.count("*").alias("posts"), F.count_if("is_op").alias("ops"))


_QUOTING = "html || case when page_id % 4 = 0 then '<pre>WARC/1.0' || chr(13) || chr(10) || 'Content-Length: 9' || chr(13) || chr(10) || chr(13) || chr(10) || '</pre>' else '' end"
_WARC_SQL = f"select url as uri, md5({_QUOTING}) as body_md5 from pages where page_id % 5 <> 0 and page_id % 7 <> 0"


def _responses(spark, sf):
    """Pages as records of a web archive; every fourth page quotes the beginning of a record."""
    n = F.col("page_id")
    html = F.concat(F.coalesce("html", F.lit("")), F.when(n % 4 == 0, f"<pre>{W.SEPARATOR}Content-Length: 9\r\n\r\n</pre>").otherwise(""))
    chunked = F.concat(F.lower(F.hex(F.octet_length(html))), F.lit("\r\n"), html, F.lit("\r\n0\r\n\r\n"))
    http = F.concat(F.lit("HTTP/1.1 "), F.when(n % 5 == 0, "404 Gone").otherwise("200 OK"), F.lit("\r\nContent-Type: "), F.when(n % 7 == 0, "image/png").otherwise("text/html; charset=utf-8"), F.when(n % 3 == 0, "\r\nTransfer-Encoding: chunked").otherwise(""), F.lit("\r\n\r\n"), F.when(n % 3 == 0, chunked).otherwise(html))
    return table(spark, sf, "pages").select(F.concat(F.lit(W.SEPARATOR + "WARC-Type: response\r\nWARC-Target-URI: "), "url", F.lit("\r\nWARC-Date: 2020-01-01T00:00:00Z\r\nContent-Length: "), F.octet_length(http).cast("string"), F.lit("\r\n\r\n"), http, F.lit("\r\n\r\n")))


@query(_WARC_SQL, "unused as (select 1)")
def scan_warc(spark, sf):
    path = text_files(_responses(spark, sf), "warc")
    return W.html_pages(W.read_responses(spark, path), "^https?://").select("uri", F.md5("body").alias("body_md5"))


@query(_WARC_SQL, "unused as (select 1)")
def scan_warc_gz(spark, sf):
    path = text_files(_responses(spark, sf), "warc", "gzip")
    return W.html_pages(W.read_responses(spark, path), "^https?://").select("uri", F.md5("body").alias("body_md5"))


@query("select distinct regexp_replace(regexp_replace(regexp_replace(url, '^https?://', ''), '/$', ''), '[^A-Za-z0-9._-]+', '_', 'g') || '.html' as name from pages where page_id % 5 <> 0 and page_id % 7 <> 0 and regexp_matches(url, '^https?://')", "unused as (select 1)")
def extract_warc(spark, sf):
    """Pages of an archive written as one file each, and the files there."""
    path = f"{shared_folder(spark)}/extracted-{uuid.uuid4().hex}"
    W.extract_pages(W.html_pages(W.read_responses(spark, text_files(_responses(spark, sf), "warc")), "^https?://"), path)
    return spark.read.format("binaryFile").load(path).select(F.substring_index("path", "/", -1).alias("name"))


# ---- a store that grows, and streams: staged lines are written in a few files, and each is a batch


@query("""select site, board, post_no, source_rank, md5(body_text) as body_md5 from offers where subnum = 0
 qualify row_number() over (partition by site, board, post_no order by source_rank) = 1""", OFFERS)
def sync_archive(spark, sf):
    """Two archives, stored one after the other in the order of a lock list; the first writer of a post wins."""
    rows = offers(spark, sf).withColumn("source_rank", F.col("source_rank").cast("int"))
    archive = Archive(spark, f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}", indexes=())
    archive.sync(["1"], lambda n: rows.filter(F.col("source_rank") == int(n)).withColumn("rank_kept", F.col("source_rank")))
    archive.sync(["1", "2"], lambda n: rows.filter(F.col("source_rank") == int(n)).withColumn("rank_kept", F.col("source_rank")))
    return archive.store().posts.select("site", "board", "post_no", F.col("rank_kept").alias("source_rank"), F.md5("body_text").alias("body_md5"))


def _streamed(spark, rows):
    """Posts as a stream of staged lines in four files, and a folder for what is kept of them."""
    line = F.to_json(F.struct("site", "board", F.col("post_no").alias("num"), F.col("thread_no").alias("thread_num"), F.col("ts_utc").alias("timestamp"), F.col("subject").alias("title")))
    path = text_files(rows.select(line).repartition(4), "stream")
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(path)
    return J.stored(J.staged_posts(lines.withColumnRenamed("value", "line"))).withColumn("source_id", F.lit(1)), f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"


@query("select distinct site, board, post_no, ts_utc from posts")
def stream_store(spark, sf):
    """Posts that come twice, in any batches, and are kept once."""
    p = posts(spark, sf)
    stream, folder = _streamed(spark, p.unionByName(p))
    S.keep_posts(stream, f"{folder}/posts", f"{folder}/checkpoint", 8).awaitTermination()
    return S.read_posts(spark, f"{folder}/posts").select("site", "board", "post_no", "ts_utc")


@query(f"select site, board, width, {_BUCKETS} from event_posts join wide using (site, board) group by all", _WIDTHS)
def stream_dates_adaptive(spark, sf):
    """The histogram of `post_dates_adaptive`, from a stream."""
    rows = event_posts(spark, sf).withColumns({"thread_no": F.col("post_no"), "subject": F.lit(None).cast("string")})
    stream, folder = _streamed(spark, rows)
    V.keep_adaptive(stream, f"{folder}/states", f"{folder}/checkpoint", 50, series=["site", "board"]).awaitTermination()
    return V.read_adaptive(spark, f"{folder}/states", 50, series=["site", "board"])


_RANGE = "case when ts_utc is null then 'undated' when ts_utc >= epoch(date '1996-03-01') and ts_utc < epoch(date '1998-10-01') then 'dated' else 'outside' end"


@query(f"select source_id, board, count(*) filter (k = 'dated') as dated, count(*) filter (k = 'undated') as undated, count(*) filter (k = 'outside') as outside from (select *, {_RANGE} as k from posts) group by all")
def range_report(spark, sf):
    """What a ranged scan keeps of each source and board, and what it leaves out for want of a date or for its date."""
    return P.range_report(posts(spark, sf), "1996-03", "1998-09")


@query(f"select board, post_no, ts_utc, {_RANGE} as kind from posts where board is not null")
def stream_by_date(spark, sf):
    """One pass over a stream into folders for dated, undated and other posts."""
    stream, folder = _streamed(spark, posts(spark, sf))
    S.keep_by_date(stream, folder, f"{folder}/checkpoint", "1996-03", "1998-09").awaitTermination()
    return S.read_by_date(spark, folder).select("board", "post_no", "ts_utc", F.col("kind").cast("string").alias("kind"))


# ---- headers read from pictures: images have four labels each


_IMAGE = "'img' || (event_id // 4) || '.png'"
_LABEL = f"strftime({_DAY}, '%m/%d/%y(%a)') || lpad((event_id % 24)::varchar, 2, '0') || ':' || lpad((event_id % 60)::varchar, 2, '0')"


def _labels(spark, sf):
    """A label and its markdown row for each event, numbered from 10, for a header has two digits at least."""
    n = F.col("event_id")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    day = F.make_date((2004 + n % 15).cast("int"), (1 + n % 12).cast("int"), (1 + n % 28).cast("int"))
    real = F.get(F.array(*[F.lit(x) for x in O.WEEKDAYS]), F.dayofweek(day) - 1)
    date = F.concat(F.date_format(day, "MM/dd/yy"), F.lit("("), real, F.lit(")"), two(n % 24), F.lit(":"), two(n % 60))
    image = F.concat(F.lit("img"), F.floor(n / 4).cast("string"), F.lit(".png"))
    row = F.concat(F.lit("| "), (n + 10).cast("string"), F.lit(" | "), date, F.when(n % 2 == 0, " UTC-4").otherwise(""), F.lit(" | [["), image, F.lit("]] |"))
    return O.label_rows(table(spark, sf, "events").select("event_id", row.alias("value"))).withColumn("label", O.label_text(F.col("date"), F.col("utc_offset"), F.col("post_no")))


@query(f"select event_id, {_IMAGE} as image, event_id + 10 as post_no, {_LABEL} as date, case when event_id % 2 = 0 then '-4' end as utc_offset from events", "unused as (select 1)")
def ocr_labels(spark, sf):
    return _labels(spark, sf).select("event_id", "image", "post_no", "date", "utc_offset")


@query("select event_id, (case event_id % 3 when 0 then 0 else 1 end)::int as distance from events", "unused as (select 1)")
def ocr_distance(spark, sf):
    n = F.col("event_id")
    read = F.when(n % 3 == 0, F.col("label")).when(n % 3 == 1, F.replace("label", F.lit("No."), F.lit("N0."))).otherwise(F.replace("label", F.lit("("), F.lit("[")))
    return _labels(spark, sf).select("event_id", O.header_distance(F.concat(F.lit("Anonymous  "), read), F.col("label")).alias("distance"))


_LINES = f"lines as (select event_id, {_LABEL} || case when event_id % 2 = 0 then 'UTC-4' else '' end || 'No.' || (event_id + 10) as label from events)"


@query("select a.event_id, levenshtein(a.label, b.label)::int as distance from lines a join lines b on b.event_id = a.event_id + 1", _LINES)
def levenshtein_lines(spark, sf):
    """The edit distance of each header line to the next event's, in the JVM; lines have some thirty letters."""
    line = _labels(spark, sf).select("event_id", "label")
    before = line.select((F.col("event_id") + 1).alias("event_id"), F.col("label").alias("before"))
    return line.join(before, "event_id").select((F.col("event_id") - 1).alias("event_id"), F.levenshtein("before", "label").alias("distance"))


def _numbered(spark, sf):
    return _labels(spark, sf).withColumn("label_no", (F.col("event_id") % 4).cast("int")).withColumn("board", F.lit("x"))


def _read_lines(labels):
    """Each label as a line, in the opposite order; every fourth with a weekday that is wrong for its date."""
    text = F.when(F.col("event_id") % 4 == 1, F.regexp_replace("label", r"\(\w+\)", F.concat(F.lit("("), F.when(F.contains("label", F.lit("(Mon)")), "Tue").otherwise("Mon"), F.lit(")")))).otherwise(F.col("label"))
    return labels.select("image", (3 - F.col("label_no")).alias("line_no"), F.concat(F.lit("Anonymous "), text).alias("line"))


@query(f"select {_IMAGE} as image, (event_id % 4)::int as label_no, (3 - event_id % 4)::int as line_no from events", "unused as (select 1)")
def ocr_assign(spark, sf):
    labels = _numbered(spark, sf)
    return O.assign(_read_lines(labels), labels.select("image", "label_no", "label")).select("image", "label_no", "line_no")


@query(f"select {_IMAGE} as image, count(*) as labels, count(*) as found, count(*) filter (event_id % 4 <> 1) as exact, 0::bigint as wrong, count(*) filter (event_id % 4 <> 1) as reads from events group by 1", "unused as (select 1)")
def ocr_score(spark, sf):
    labels = _numbered(spark, sf)
    return O.score(_read_lines(labels), labels)
