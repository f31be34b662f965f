"""Posts from JSON: staged lines, per-thread API files, exported objects and scraped threads.

Each reader is a text scan with an explicit schema and plain expressions. The parsing functions take a text column, so they
also work on streams. A bad line gives a row without post_no, which `stored` leaves out and `counters` counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.texts import number_or_null, strip_html, strip_nulls, text_or_null
from boardlake.operators.filters import is_ghost

#: Schemas of the formats; fixed values.
STAGED = "site string, board string, num string, subnum string, thread_num string, op string, timestamp string, name string, trip string, title string, comment string, media_filename string, media_hash string"
API = "posts array<struct<no:bigint,resto:bigint,time:bigint,name:string,trip:string,sub:string,com:string,filename:string,ext:string,md5:string>>"
EXPORT = "num string, subnum string, thread_num string, op string, timestamp string, name string, trip string, title string, comment string, board struct<name:string,shortname:string>, media struct<media_filename:string,media_hash:string>"
SCRAPED = "Thread struct<Posts:array<struct<OriginalObject:struct<num:string,subnum:string,thread_num:string,timestamp:string,name:string,trip:string,title:string,comment_sanitized:string,deleted:string,media:struct<media_filename:string,media_hash:string>>>>>"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line and file. Lines end at line feeds alone; one carriage return before it goes, other separators are content."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.regexp_replace("value", r"\r\z", "").alias("line"), F.col("_metadata.file_path").alias("file"))


def board_of(file: Column) -> Column:
    """The folder that a file lies in."""
    return F.regexp_extract(file, "([^/]+)/[^/]+$", 1)


def _row(p: Column, site: Column, board: Column, thread: Column, title: Column, comment: Column, media: Column) -> list[Column]:
    clean = lambda c: strip_nulls(text_or_null(c))
    return [
        site.alias("site"), board.alias("board"), thread.alias("thread_no"), number_or_null(p["num"]).alias("post_no"), number_or_null(p["timestamp"]).alias("ts_utc"),
        clean(p["name"]).alias("name"), clean(p["trip"]).alias("tripcode"), clean(title).alias("subject"), clean(comment).alias("body_text"),
        clean(media["media_filename"]).alias("media_filename"), clean(media["media_hash"]).alias("media_md5"), p["subnum"].alias("subnum"),
    ]


def _thread(p: Column) -> Column:
    """A thread pointer of 0 means the post itself."""
    return F.coalesce(F.nullif(number_or_null(p["thread_num"]), F.lit(0).cast("long")), number_or_null(p["num"]))


def _is_op(p: Column) -> Column:
    return F.coalesce(p["op"].try_cast("int") == 1, _thread(p) == number_or_null(p["num"]))


def staged_posts(rows: DataFrame, line: str = "line", site: str = "site0", board: Column | None = None) -> DataFrame:
    """A post for each staged line; a record's own site wins. Times are UTC."""
    p = F.col("_p")
    rows = rows.withColumn("_p", F.from_json(line, STAGED))
    place = F.coalesce(p["board"], board) if board is not None else p["board"]
    return rows.select(*_row(p, F.coalesce(p["site"], F.lit(site)), place, _thread(p), p["title"], p["comment"], p), _is_op(p).alias("is_op"))


def api_posts(rows: DataFrame, board: Column, thread: Column, text: str = "text", site: str = "site0") -> DataFrame:
    """The posts of per-thread API objects; an opening post has resto 0 or the thread's number. Mark-up goes from title and body."""
    each = rows.select(board.alias("board"), thread.cast("long").alias("thread_no"), F.explode(F.from_json(text, API)["posts"]).alias("p"))
    p = F.col("p")
    strip = lambda c: text_or_null(strip_html(c))
    return each.select(
        F.lit(site).alias("site"), "board", "thread_no", p["no"].alias("post_no"), ((p["resto"] == 0) | (p["no"] == F.col("thread_no"))).alias("is_op"), p["time"].alias("ts_utc"),
        text_or_null(p["name"]).alias("name"), text_or_null(p["trip"]).alias("tripcode"), strip(p["sub"]).alias("subject"), strip(p["com"]).alias("body_text"),
        F.concat(p["filename"], p["ext"]).alias("media_filename"), p["md5"].alias("media_md5"),
    )


def exported_posts(rows: DataFrame, line: str = "line", site: str = "site0") -> DataFrame:
    """A post for each exported object: numbers are texts, board and media are nested, empty texts are null."""
    p = F.col("_p")
    rows = rows.withColumn("_p", F.from_json(line, EXPORT))
    return rows.select(*_row(p, F.lit(site), p["board"]["shortname"], _thread(p), p["title"], p["comment"], p["media"]), _is_op(p).alias("is_op"))


def scraped_posts(rows: DataFrame, board: Column, thread: Column, text: str = "text", site: str = "site0") -> DataFrame:
    """The posts of scraped threads; the folder's thread wins over the record's (mismatch says where they differ), deleted ones stay."""
    each = rows.select(board.alias("board"), thread.cast("long").alias("thread"), F.explode(F.from_json(text, SCRAPED)["Thread"]["Posts"]).alias("o"))
    p = F.col("o.OriginalObject")
    out = _row(p, F.lit(site), F.col("board"), F.col("thread"), p["title"], p["comment_sanitized"], p["media"])
    return each.select(*out, (F.col("thread") == number_or_null(p["num"])).alias("is_op"), F.coalesce(p["deleted"].isin("1", "true"), F.lit(False)).alias("deleted"), (number_or_null(p["thread_num"]) != F.col("thread")).alias("mismatch"))


def stored(posts: DataFrame) -> DataFrame:
    """The rows that a store takes: a number, a board and no ghost."""
    return posts.filter(F.col("post_no").isNotNull() & F.col("board").isNotNull() & ~is_ghost(F.col("subnum"))).drop("subnum")


def counters(posts: DataFrame) -> DataFrame:
    """One row: all rows, bad ones (no number or board), ghosts."""
    bad = F.col("post_no").isNull() | F.col("board").isNull()
    return posts.agg(F.count("*").alias("rows"), F.count_if(bad).alias("bad"), F.count_if(~bad & is_ghost(F.col("subnum"))).alias("ghost"))


def stage(posts: DataFrame, root: str) -> None:
    """Writes posts as staged lines, <root>/board=<board>/, which `read_staged_folders` reads back."""
    text = lambda c: F.col(c).cast("string")
    lines = posts.select("board", "site", text("post_no").alias("num"), F.lit("0").alias("subnum"), text("thread_no").alias("thread_num"), F.when(F.col("is_op"), "1").otherwise("0").alias("op"), text("ts_utc").alias("timestamp"), *[F.col(a).alias(b) for a, b in (("name", "name"), ("tripcode", "trip"), ("subject", "title"), ("body_text", "comment"), ("media_filename", "media_filename"), ("media_md5", "media_hash")) if a in posts.columns])
    write_staged(lines, root)


def read_staged_folders(spark: SparkSession, root: str, site: str = "site0") -> DataFrame:
    """The posts that `stage` wrote."""
    board = F.regexp_extract("file", "/board=([^/]*)/", 1)
    return staged_posts(read_lines(spark, f"{root}/board=*/"), site=site, board=board)


def read_staged(spark: SparkSession, root: str, site: str = "site0") -> DataFrame:
    """<root>/<board>/posts.ndjson"""
    return staged_posts(read_lines(spark, f"{root}/*/posts.ndjson"), site=site, board=board_of(F.col("file")))


def write_staged(posts: DataFrame, root: str) -> None:
    """One folder of JSON lines for each board."""
    posts.write.partitionBy("board").json(root)


def read_files(spark: SparkSession, root: str, names: str) -> DataFrame:
    """(file, text) of all files below a folder whose name fits, whole."""
    text = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=names)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


#: Where per-thread files lie: <board>/<no>.json, <board>/<board> <no>.json, <board>/<no>/<no>.json; .txt is as good.
API_PATH = r"/([A-Za-z0-9]+)/(?:\d+/)?(?:\1(?: |%20))?(\d+)\.(?:json|txt)$"
#: Where scraped threads lie: <board>/<no>/thread.json.
SCRAPED_PATH = r"^(.*)/([A-Za-z0-9]+)/(\d+)/thread\.json$"


def read_api_threads(spark: SparkSession, root: str, site: str = "site0") -> DataFrame:
    """The posts of per-thread API files, board and thread from their path."""
    files = read_files(spark, root, "*.{json,txt}").filter(F.col("file").rlike(API_PATH))
    return api_posts(files, F.regexp_extract("file", API_PATH, 1), F.regexp_extract("file", API_PATH, 2), site=site)


def read_exported(spark: SparkSession, path: str, site: str = "site0") -> DataFrame:
    """The posts of exported objects, one a line."""
    return exported_posts(read_lines(spark, path), site=site)


def read_scraped(spark: SparkSession, root: str, site: str = "site0") -> DataFrame:
    """The posts of scraped threads below a folder, at any depth."""
    files = read_files(spark, root, "thread.json").filter(F.col("file").rlike(SCRAPED_PATH))
    return scraped_posts(files, F.regexp_extract("file", SCRAPED_PATH, 2), F.regexp_extract("file", SCRAPED_PATH, 3), site=site)


def scraped_roots(spark: SparkSession, root: str) -> DataFrame:
    """(root, threads): the folders below one that hold boards of scraped threads. Only file names are read."""
    names = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="thread.json").select(F.col("_metadata.file_path").alias("file"))
    return names.filter(F.col("file").rlike(SCRAPED_PATH)).groupBy(F.regexp_extract("file", SCRAPED_PATH, 1).alias("root")).agg(F.count("*").alias("threads"))
