"""Posts from MySQL dumps: statements are cut by Spark's text scan, a small helper reads literals and tuples.

A dump is scanned as records that end before each line with an INSERT head, so the statements of one file are read by many
tasks. A post may quote such a line, so whether a head begins a statement depends on the literals before it: see `records`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.functions.batches import mapped
from boardlake.functions.texts import number_or_null, strip_nulls
from boardlake.functions.times import ny_wall_to_utc
from boardlake.operators.filters import is_ghost
from boardlake.sources import framing

#: Escapes of MySQL literals; fixed values.
ESCAPES = {"0": "\0", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a", "b": "\b"}
#: Columns that a table of posts must have; fixed values.
REQUIRED = ("num", "subnum", "thread_num", "timestamp", "comment")
#: Column names of the older schema and what they are called in the newer one, all at once; fixed values.
OLDER_NAMES = {"media_filename": "media_orig", "media": "media_filename", "parent": "thread_num"}
TOKEN = re.compile(r"'((?:[^'\\]|\\.|'')*+)'|([^\s,()';]+)|([(),;])", re.DOTALL)
INSERT = "INSERT INTO `"
IN_LITERAL = re.compile(r"(?:[^'\\]++|\\.|'')*+", re.DOTALL)
CLOSED = re.compile(r"'\s*[,)]")
IN_VALUES = re.compile(r"(?:[^';]++|'(?:[^'\\]++|\\.|'')*+')*+", re.DOTALL)
HEAD = re.compile(r"^﻿?INSERT INTO `([^`]+)`\s*(?:\(([^)]*)\))?\s*VALUES\s*", re.MULTILINE)
#: The head of a table's definition in a dump; fixed value.
CREATE = re.compile(r"^CREATE TABLE (?:IF NOT EXISTS )?`([^`]+)` \(\r?\n((?:[^)].*\n?)*)", re.MULTILINE)
ROW = T.ArrayType(T.ArrayType(T.StringType()))
NAMES = T.ArrayType(T.StringType())
STATEMENTS = T.ArrayType(T.StructType([T.StructField("table", T.StringType()), T.StructField("columns", NAMES), T.StructField("rows", ROW), T.StructField("bad", T.IntegerType())]))
TABLES = T.ArrayType(T.StructType([T.StructField("table", T.StringType()), T.StructField("columns", NAMES)]))
ARROW_ROW, ARROW_NAMES = pa.list_(pa.list_(pa.string())), pa.list_(pa.string())
ARROW_STATEMENTS = pa.list_(pa.struct([("table", pa.string()), ("columns", ARROW_NAMES), ("rows", ARROW_ROW), ("bad", pa.int32())]))
ARROW_TABLES = pa.list_(pa.struct([("table", pa.string()), ("columns", ARROW_NAMES)]))


def literal(text: str) -> str:
    return re.sub(r"\\(.)|''", lambda m: ESCAPES.get(m[1], m[1]) if m[1] is not None else "'", text, flags=re.DOTALL)


def complete_tuples(text: str, at: int = 0) -> tuple[list[list[str | None]], int, bool]:
    """(rows, where reading stopped, whether a literal or tuple is open there) of a VALUES list; it ends at a semicolon or at what is no tuple."""
    rows: list[list[str | None]] = []
    row: list[str | None] | None = None
    while m := TOKEN.search(text, at):
        if "'" in text[at : m.start()]:
            return rows, at, True
        if row is None and m[3] not in ("(", ","):
            return rows, m.end() if m[3] == ";" else m.start(), False
        at = m.end()
        if m[3] == "(" and row is None:
            row = []
        elif m[3] == ")":
            rows.append(row)
            row = None
        elif row is not None and m[3] is None:
            row.append(literal(m[1]) if m[1] is not None else None if m[2].upper() == "NULL" else m[2])
    return rows, at, row is not None or "'" in text[at:]


def tuples_of(text: str) -> list[list[str | None]]:
    """The rows of a VALUES list; an open literal or parenthesis is an error."""
    rows, _, is_open = complete_tuples(text)
    if is_open:
        raise ValueError("a literal or tuple is not closed")
    return rows


@F.arrow_udf(ROW)
def _tuples(texts: pa.Array) -> pa.Array:
    return mapped(lambda t: None if t is None else tuples_of(t), ARROW_ROW, texts)


def parse_tuples(values: Column) -> Column:
    """array<array<string>> of a VALUES list; null for null."""
    return _tuples(values)


def insert_parts(statement: Column) -> tuple[Column, Column, Column]:
    """Table, named columns (empty if none are named) and the VALUES list of an INSERT statement."""
    head = r"(?is)^\s*INSERT\s+INTO\s+`([^`]+)`\s*(?:\(([^)]*)\))?\s*VALUES\s*(.*?);?\s*$"
    names = F.regexp_extract_all(F.regexp_extract(statement, head, 2), F.lit("`([^`]+)`"), F.lit(1))
    return F.regexp_extract(statement, head, 1), names, F.regexp_extract(statement, head, 3)


def pieces_of(record: str) -> Iterator[tuple]:
    """("insert", table, columns or None, rows, open) and ("between", text) in turn, over the statements of a record."""
    at = 0
    while m := HEAD.search(record, at):
        yield "between", record[at : m.start()]
        rows, at, is_open = complete_tuples(record, m.end())
        names = re.findall("`([^`]+)`", m[2] or "") or None
        yield "insert", m[1], names, rows, is_open
        if is_open:
            return
    yield "between", record[at:]


@F.arrow_udf(STATEMENTS)
def _statements(records: pa.Array) -> pa.Array:
    return mapped(lambda r: [{"table": p[1], "columns": p[2], "rows": p[3], "bad": int(p[4])} for p in pieces_of(r) if p[0] == "insert"], ARROW_STATEMENTS, records)


@F.arrow_udf(TABLES)
def _created(records: pa.Array) -> pa.Array:
    def tables(record: str) -> list[dict]:
        found = [m for p in pieces_of(record) if p[0] == "between" for m in CREATE.finditer(p[1])]
        return [{"table": m[1], "columns": re.findall(r"^\s*`([^`]+)`", m[2], re.MULTILINE)} for m in found]

    return mapped(tables, ARROW_TABLES, records)


def literal_end(text: str, at: int, is_open: bool) -> tuple[bool, bool]:
    """(whether a literal is open at the end of a statement's text, whether the text can stand where it is said to).

    `at` is where the VALUES list, or if a literal is open the rest of the literal, begins. A literal that was open closes
    before a comma or parenthesis; where it doesn't, it was not this text that it went on with.
    """
    if is_open:
        at = IN_LITERAL.match(text, at).end()
        if at == len(text):
            return True, True
        if not CLOSED.match(text, at):
            return False, False
        at += 1
    at = IN_VALUES.match(text, at).end()
    return at < len(text) and text[at] == "'", True


def piece_state(piece: str, is_open: bool) -> tuple[bool, bool]:
    """(whether a literal is open after a piece, whether the piece goes on with the one that was) for a piece and whether one was open before it."""
    if is_open:
        after, fits = literal_end(piece, 0, True)
        if fits:
            return after, True
    head = HEAD.match(piece)
    return (literal_end(piece, head.end(), False)[0] if head else False), False


def split_pieces(key: tuple[str, int], values: Iterator[bytes]) -> Iterator[str]:
    """The pieces of a split with what the scan cut off before them; only a file's first piece has nothing before it."""
    for k, v in enumerate(values):
        text = v.decode("utf-8", "replace")
        yield text if k == 0 and key[1] == 0 else INSERT + text


def _split_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, block), values in framing.by_split(batches):
        # by the state before the split: the state now, and whether all so far was inside the one literal
        now, through = [False, True], [False, True]
        for piece in split_pieces((file, block), values):
            for k in (0, 1):
                now[k], goes_on = piece_state(piece, now[k])
                through[k] = through[k] and goes_on and now[k]
        yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "closed": [now[0]], "open": [now[1]], "through": [through[1]]})


def open_splits(summaries: list) -> dict[tuple[str, int], int]:
    """For each split that begins inside a literal: where the split begins in which that statement does."""
    out = {}
    for own in framing.in_order(summaries):
        owner = None
        for r in own:
            if owner is None:
                owner = r["block"] if r["closed"] else None
                continue
            out[r["file"], r["block"]] = owner
            owner = None if not r["open"] else owner if r["through"] else r["block"]
    return out


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record): a dump cut before each INSERT head at the beginning of a line, but not inside a literal.

    Every split tells whether it ends inside a literal for either way it may begin (`framing`), so quoted heads cost nothing
    wherever they stand. A literal that is never closed ends with its statement: the next head that can't be inside it begins anew.
    """
    scan = framing.pieces(spark, path, f"\n{INSERT}")
    states = scan.mapInArrow(_split_states, "file string, block long, closed boolean, open boolean, through boolean").collect()
    begun = open_splits(states)

    def read(key: tuple[str, int], values: Iterator[bytes]) -> Iterator[tuple[int | None, bytes]]:
        owner = begun.get(key)
        held, is_open = [], owner is not None
        for piece in split_pieces(key, values):
            after, goes_on = piece_state(piece, is_open)
            if not goes_on and (held or owner is not None):
                yield owner, "".join(held).encode()
                held, owner = [], None
            held.append("\n" + piece if goes_on else piece)
            is_open = after
        yield (owner if owner is not None else key[1] if is_open else None), "".join(held).encode()

    return framing.joined(framing.fragments(scan, read)).select("file", F.decode("record", "UTF-8").alias("record"))


def created_tables(cut: DataFrame) -> DataFrame:
    """(file, table, declared): the columns of every CREATE TABLE of a dump, in order."""
    some = cut.filter(F.contains("record", F.lit("CREATE TABLE")))
    return some.select("file", F.inline(_created("record")).alias("table", "declared")).dropDuplicates(["file", "table"])


def normal_columns(columns: Column, names: dict[str, str] | None = None) -> Column:
    """An array of column names with the older schema's names replaced, all at once, so no two get the same name."""
    pairs = F.create_map(*[F.lit(x) for pair in (names or OLDER_NAMES).items() for x in pair])
    return F.transform(columns, lambda c: F.coalesce(F.element_at(pairs, c), c))


def holds_posts(columns: Column) -> Column:
    """Whether a table with these columns holds posts; others are side tables."""
    return F.forall(F.array(*[F.lit(c) for c in REQUIRED]), lambda c: F.array_contains(columns, c))


def side_tables(spark: SparkSession, path: str, older: bool = False) -> DataFrame:
    """(file, table, declared) of the tables that are left out for want of a column."""
    tables = created_tables(records(spark, path))
    declared = normal_columns(F.col("declared")) if older else F.col("declared")
    return tables.filter(~holds_posts(declared))


def of_boards(statements: DataFrame, boards: Sequence[str]) -> DataFrame:
    """The records whose INSERT is into a board's table, or that of its deleted posts; known from the head, so others are not parsed."""
    names = [n for b in boards for n in (b, f"{b}_deleted")]
    return statements.filter(F.regexp_extract("record", r"^\W?INSERT INTO `([^`]+)`", 1).isin(names))


def dump_rows(spark: SparkSession, path: str, older: bool = False, boards: Sequence[str] | None = None) -> DataFrame:
    """(file, table, names, v): the values of every row of every table with posts, or of some boards'; the INSERT's own column list wins over the CREATE TABLE's."""
    cut = records(spark, path)
    each = (cut if boards is None else of_boards(cut, boards)).select("file", F.inline(_statements("record")).alias("table", "columns", "rows", "bad"))
    known = each.join(created_tables(cut), ["file", "table"], "left").withColumn("names", F.coalesce("columns", "declared"))
    if older:
        known = known.withColumn("names", normal_columns(F.col("names")))
    return known.filter(holds_posts(F.col("names"))).select("file", "table", "names", F.explode("rows").alias("v"))


def read_dump(spark: SparkSession, path: str, site: str = "site0", older: bool = False, boards: Sequence[str] | None = None) -> DataFrame:
    """The posts of a dump, or of some boards. Times are New York wall times; a table <board>_deleted has posts of the same board; ghosts stay, with their subnum."""
    at = lambda name: F.get("v", F.array_position("names", F.lit(name)).cast("int") - 1)
    field = lambda name: F.when(F.array_contains("names", name), strip_nulls(at(name)))
    post_no, stamp = number_or_null(at("num")), number_or_null(at("timestamp"))
    thread_no = F.coalesce(F.nullif(number_or_null(at("thread_num")), F.lit(0).cast("long")), post_no)
    rows = dump_rows(spark, path, older, boards)
    return rows.select(
        F.lit(site).alias("site"), F.regexp_replace("table", "_deleted$", "").alias("board"), thread_no.alias("thread_no"), post_no.alias("post_no"),
        F.when(F.array_contains("names", "op"), F.coalesce(at("op") == "1", F.lit(False))).otherwise(thread_no == post_no).alias("is_op"),
        F.when(stamp > 0, ny_wall_to_utc(stamp)).alias("ts_utc"), field("name").alias("name"), field("trip").alias("tripcode"), field("title").alias("subject"),
        field("comment").alias("body_text"), field("media_filename").alias("media_filename"), field("media_hash").alias("media_md5"), at("subnum").alias("subnum"),
    )


def stored(posts: DataFrame) -> DataFrame:
    """The rows that a store takes: those with a number and no ghosts."""
    return posts.filter(F.col("post_no").isNotNull() & ~is_ghost(F.col("subnum"))).drop("subnum")
