"""Mark-up, entities, names and numbers in text columns."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.functions.batches import mapped

#: Named character references that are decoded, in this order; the ampersand comes last, so that nothing is decoded twice.
NAMED = [("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", " ")]


def decode_named(text: Column) -> Column:
    """Named references, in any case, each once."""
    for name, letter in NAMED:
        text = F.regexp_replace(text, f"(?i)&{name};", letter)
    return F.regexp_replace(text, "(?i)&amp;", "&")


#: A numeric character reference; fixed value.
NUMERIC = re.compile(r"(?i)&#(?:x([0-9a-f]{1,8})|([0-9]{1,8}));")


@F.arrow_udf(T.StringType())
def _numeric(texts: pa.Array) -> pa.Array:
    def letter(m) -> str:
        n = int(m[1], 16) if m[1] else int(m[2])
        return chr(n) if 0 < n < 0x110000 and not 0xD800 <= n < 0xE000 else m[0]

    return mapped(lambda t: None if t is None else NUMERIC.sub(letter, t), pa.string(), texts)


def decode_entities(text: Column) -> Column:
    """Numeric and named references, each once. Only texts with a numeric one leave the JVM."""
    return decode_named(F.when(text.contains("&#"), _numeric(text)).otherwise(text))


#: Steps of an edit distance between two cuts of the bits over the end.
LOOSE_STEPS = 64


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance of whole strings by code point: a column of the matrix is two big integers of vertical steps (Myers, Hyyrö)."""
    if a == b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
    places = {c: int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little") for c in set(b)}
    full = (1 << len(a)) - 1
    up, down = full, 0
    for at in range(0, len(b), LOOSE_STEPS):
        for c in b[at : at + LOOSE_STEPS]:
            same = places[c]
            xv = same | down
            xh = (same & up) + up ^ up | same
            ph = (down | full ^ (xh | up)) << 1 | 1
            up = (up & xh) << 1 | full ^ (xv | ph)
            down = ph & xv
        up, down = up & full, down & full  # bits over the end never reach those below, so they are cut off now and then
    return len(b) + up.bit_count() - down.bit_count()


@F.arrow_udf(T.IntegerType())
def _levenshtein(left: pa.Array, right: pa.Array) -> pa.Array:
    return mapped(lambda a, b: None if a is None or b is None else edit_distance(a, b), pa.int32(), left, right)


def levenshtein(left: Column | str, right: Column | str) -> Column:
    """As Spark's levenshtein, for long texts: the built-in takes the cells of the matrix one by one."""
    return _levenshtein(left, right)


def strip_html(text: Column) -> Column:
    """`<br>` as a line feed, `<wbr>` as nothing, other tags as nothing; then named references."""
    text = F.regexp_replace(text, r"(?i)<br\s*/?>", "\n")
    text = F.regexp_replace(text, r"(?i)<wbr\s*/?>", "")
    return decode_named(F.regexp_replace(text, "<[^>]*>", ""))


def clean_body_text(text: Column) -> Column:
    """Whole tags and an unfinished one at the end go, references are decoded, white space at the end goes; null if nothing is left."""
    text = F.regexp_replace(F.regexp_replace(text, "<[^>]*>", ""), "<[^>]*$", "")
    return F.nullif(F.regexp_replace(decode_named(text), r"[\s ]+$", ""), F.lit(""))


def strip_nulls(text: Column) -> Column:
    return F.regexp_replace(text, "\x00", "")


def number_or_null(text: Column) -> Column:
    """The integer that a text of digits stands for."""
    return F.when(text.rlike(r"^-?\d+$"), text.try_cast("long"))


def valid_number_text(text: Column) -> Column:
    """The positive integer that a text of digits stands for."""
    n = number_or_null(text)
    return F.when(n > 0, n)


def text_or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def file_name_from(info: Column) -> Column:
    """The original name in a file line: the last field in its closing parentheses unless that is a size, else the token after "File:"."""
    last = F.trim(F.element_at(F.split(F.regexp_extract(info, r"\(([^()]*)\)\s*$", 1), ","), -1))
    size = last.rlike(r"^\d+x\d+$") | last.rlike(r"(?i)^[\d.]+\s*[KMG]?B$")
    token = F.nullif(F.regexp_extract(info, r"File\s*:?\s*([^\s-]+)", 1), F.lit(""))
    return F.when((last != "") & ~size, last).otherwise(token)


def normal_title(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def title_board(text: Column) -> Column:
    """The board that a title "/b/ - ..." names."""
    return F.nullif(F.regexp_extract(normal_title(text), "^/([a-z0-9]+)/ - ", 1), F.lit(""))


def thread_from_name(name: Column) -> Column:
    """The thread that a page's file name asserts: digits only, before the ending."""
    return F.regexp_extract(name, r"^(\d+)\.html?$", 1).try_cast("long")


def nested_thread(name: Column) -> Column:
    """Leading digits of a file name."""
    return F.regexp_extract(name, r"^(\d+)", 1).try_cast("long")


def flat_identity(name: Column) -> tuple[Column, Column]:
    """(board, thread) of a file name <board>_<no>.html."""
    pattern = r"^([a-z0-9]+)_(\d+)\.html?$"
    return F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")), F.regexp_extract(name, pattern, 2).try_cast("long")


def url_slug(url: Column) -> Column:
    """A file name for a URL: no scheme, no slash at the end, runs of other characters as "_"."""
    bare = F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://", ""), r"/+$", "")
    return F.concat(F.regexp_replace(bare, "[^A-Za-z0-9._-]+", "_"), F.lit(".html"))


def url_site_board(url: Column, domain: str, site: str) -> tuple[Column, Column]:
    """(site, board): hosts of domain are one site, others are kept as they are; the board is the path's first part."""
    host = F.lower(F.regexp_extract(url, r"^[a-z]+://([^/?#:]+)", 1))
    board = F.nullif(F.regexp_extract(url, r"^[a-z]+://[^/?#]+/([^/?#]+)", 1), F.lit(""))
    return F.when((host == domain) | host.endswith(f".{domain}"), site).otherwise(F.nullif(host, F.lit(""))), board


def native_identity(name: Column) -> tuple[Column, Column]:
    """(board, file) of a saved page's name, by the first rule that fits: <board>_<no>, <board>-<no>, <board>/<no>, <board>/.../<no>."""
    rules = [r"^([a-z0-9]+)_(\d+)\.html?$", r"^([a-z0-9]+)-(\d+)\.html?$", r"^([a-z0-9]+)/(\d+)(?:\.html?)?$", r"^([a-z0-9]+)/.*?(\d+)(?:\.html?)?$"]
    pick = lambda g: F.coalesce(*[F.nullif(F.regexp_extract(name, r, g), F.lit("")) for r in rules])
    return pick(1), F.concat(pick(2), F.lit(".html"))
