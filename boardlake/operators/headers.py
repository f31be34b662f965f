"""Post headers read from pictures: parsing, distances to labels, assignment of labels to lines, scores."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.functions.batches import in_pieces, mapped
from boardlake.functions.columns import let

#: A digit or what is often read for one, and the formats of dates and numbers built on it; fixed values.
DIGIT = r"[\dOoIl|SB]"
LOOSE_DATE = rf"{DIGIT}{{2}}\W?[/1l|]{DIGIT}{{2}}\W?[/1l|]{DIGIT}{{2}}"
LOOSE_NUMBER = rf"N[o0ae]?\W{{0,2}}{DIGIT}{{2,}}"
HEADER = r"(\d\d)/(\d\d)/(\d\d)\((\w{0,4})\)([\d:.,;]{4,10}?)(?:UTC[+-]\d+)?N[o0]{1,2}[.,]?([1-9]\d*)"
WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
PAIR = "image string, label_no int, line_no int, distance int"


def no_blanks(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def looks_like_header(line: Column) -> Column:
    """Something like a date, and from there on something like "No." and digits."""
    return line.rlike(rf"(?s){LOOSE_DATE}.*{LOOSE_NUMBER}")


def read_header(line: Column) -> Column:
    """A struct (post_no, date) of a header line, or null. Blanks are dropped first.

    A weekday that exists but is wrong for the date spoils it; any other is made good from the date. The time may have any
    separators, or none: four or six digits are hours, minutes and seconds.
    """
    fields = F.transform(F.array(no_blanks(line)), lambda flat: F.when(flat.rlike(HEADER), F.struct(*[F.regexp_extract(flat, HEADER, k).alias(f"g{k}") for k in range(1, 7)])))
    return F.get(F.transform(fields, _judged), F.lit(0))


def _judged(g: Column) -> Column:
    """The number and date of a header's fields (month, day, year, weekday, time, number), if they can be."""
    day = F.try_to_date(F.concat(F.lit("20"), g["g3"], F.lit("-"), g["g1"], F.lit("-"), g["g2"]), "yyyy-MM-dd")
    real = F.get(F.array(*[F.lit(n) for n in WEEKDAYS]), F.dayofweek(day) - 1)
    digits = F.regexp_replace(g["g5"], r"\D", "")
    fine = digits.rlike(r"^([01]\d|2[0-3])[0-5]\d([0-5]\d)?$") & ~(g["g4"].isin(WEEKDAYS) & (g["g4"] != real))
    time = F.regexp_replace(digits, r"(\d\d)(?=\d)", "$1:")
    text = F.concat(g["g1"], F.lit("/"), g["g2"], F.lit("/"), g["g3"], F.lit("("), real, F.lit(")"), time)
    return F.when(day.isNotNull() & fine, F.struct(g["g6"].try_cast("long").alias("post_no"), text.alias("date")))


def label_rows(text: DataFrame) -> DataFrame:
    """Label rows of markdown tables (column value, of a board's file): label_no in the order of row, image, post_no, date without its offset from UTC, utc_offset."""
    pattern = r"^\|\s*(\d+)\s*\|\s*([^|]+?)\s*\|\s*\[\[([^\]]+)\]\]\s*\|\s*$"
    line = F.trim("value")
    g = lambda k: F.regexp_extract(line, pattern, k)
    offset = F.nullif(F.regexp_extract(g(2), r"^.*?\s+UTC([+-]\d+)$", 1), F.lit(""))
    date = F.when(offset.isNotNull(), F.regexp_extract(g(2), r"^(.*?)\s+UTC[+-]\d+$", 1)).otherwise(g(2))
    others = [c for c in text.columns if c != "value"]
    return text.filter(line.rlike(pattern)).select(*others, g(3).alias("image"), g(1).try_cast("long").alias("post_no"), date.alias("date"), offset.alias("utc_offset"))


def label_text(date: Column, utc_offset: Column, post_no: Column) -> Column:
    """A label as its header reads without blanks."""
    return F.concat(date, F.coalesce(F.concat(F.lit("UTC"), utc_offset), F.lit("")), F.lit("No."), post_no.cast("string"))


def header_distance(line: Column, label: Column) -> Column:
    """The least edit distance of the label to what the line has from its first date on: to every beginning that is up to four letters shorter or longer."""
    return _distance(from_date(line), label)


def from_date(line: Column) -> Column:
    """What a line has from its first date on, or all of it, without blanks."""
    return let(no_blanks(line), lambda flat: F.substr(flat, F.greatest(F.regexp_instr(flat, F.lit(LOOSE_DATE)), F.lit(1))))


@lru_cache(1 << 12)
def places_of(label: str) -> dict[str, int]:
    """For each letter of a label the places where it stands, as bits."""
    out: dict[str, int] = {}
    for at, c in enumerate(label):
        out[c] = out.get(c, 0) | 1 << at
    return out


def least_distance(rest: str, label: str) -> int | None:
    """The least edit distance of a label to a beginning of rest that is up to four letters shorter or longer; None if rest is too short. One pass gives those of all beginnings (Myers, Hyyrö)."""
    size = len(label)
    tail, least = rest[: size + 4], max(size - 4, 1)
    if len(tail) < least:
        return None
    if not label or tail.startswith(label):
        return int(not label)
    places, full, last, up, down, now, best = places_of(label), (1 << size) - 1, 1 << (size - 1), (1 << size) - 1, 0, size, size + 4
    for n, c in enumerate(tail, 1):
        same = places.get(c, 0)
        xv = same | down
        xh = (same & up) + up ^ up | same
        ph, mh = down | full ^ (xh | up), up & xh
        now += 1 if ph & last else -1 if mh & last else 0
        ph = ph << 1 | 1
        up, down = mh << 1 | full ^ (xv | ph), ph & xv
        if n >= least and now < best:
            best = now
    return best


@F.arrow_udf(T.IntegerType())
def _distance(rest: pa.Array, label: pa.Array) -> pa.Array:
    return mapped(lambda r, x: None if r is None or x is None else least_distance(r, x), pa.int32(), rest, label)


def near_pairs(lines: DataFrame, labels: DataFrame) -> DataFrame:
    """(image, label_no, line_no, distance) of the labels (image, label_no, label) and lines (image, line_no, line) of an image that are within a third of the label in edits, four at least."""
    # rows are short and dear, so tasks are not to be merged by their bytes; what a line has from its date on is found once a line
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rests = lines.select("image", "line_no", from_date(F.col("line")).alias("_rest")).repartition(tasks, "image")
    near = rests.join(labels.select("image", "label_no", "label"), "image").withColumn("distance", _distance(F.col("_rest"), F.col("label")))
    limit = F.greatest(F.lit(4), F.floor(F.length("label") / 3))
    return near.filter(F.col("distance") <= limit).select("image", "label_no", "line_no", "distance")


def assign(lines: DataFrame, labels: DataFrame) -> DataFrame:
    """One-to-one pairs of labels and lines of an image, nearest first, of equal ones the first label and line. Pairs are read sorted, whatever their number; what is held is what one image has given so far."""

    def greedy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lines_taken, labels_taken = None, set(), set()
        for batch in (piece for whole in batches for piece in in_pieces(whole)):
            keep = []
            for at, (image, label, line) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("image", "label_no", "line_no")), strict=True)):
                if image != now:
                    now, lines_taken, labels_taken = image, set(), set()
                if line not in lines_taken and label not in labels_taken:
                    lines_taken.add(line), labels_taken.add(label), keep.append(at)
            yield batch.take(pa.array(keep, pa.int64()))

    pairs = near_pairs(lines, labels).select("image", *[F.col(c).cast("int").alias(c) for c in ("label_no", "line_no", "distance")])
    return pairs.repartition("image").sortWithinPartitions("image", "distance", "label_no", "line_no").mapInArrow(greedy, PAIR)


def score(lines: DataFrame, labels: DataFrame) -> DataFrame:
    """For each image: labels (rows), those with a line (found), those whose number and date a line reads (exact), all reads, and reads that no label of the board has (wrong).

    labels: image, label_no, board, post_no, date, label; lines: image, line_no, line.
    """
    headers = lines.filter(looks_like_header(F.col("line")))
    reads = headers.select("image", read_header(F.col("line")).alias("r")).filter("r is not null").select("image", "r.post_no", "r.date")
    boards = labels.select("image", "board").distinct()
    known = labels.select("board", "post_no", "date", F.lit(True).alias("known")).distinct()
    judged = reads.join(boards, "image").join(known, ["board", "post_no", "date"], "left").groupBy("image").agg(F.count("*").alias("reads"), F.count_if(F.col("known").isNull()).alias("wrong"))
    found = assign(headers, labels).select("image", "label_no", F.lit(True).alias("found"))
    exact = reads.distinct().withColumn("exact", F.lit(True))
    per = labels.join(found, ["image", "label_no"], "left").join(exact, ["image", "post_no", "date"], "left")
    per = per.groupBy("image").agg(F.count("*").alias("labels"), F.count("found").alias("found"), F.count("exact").alias("exact"))
    return per.join(judged, "image", "left").select("image", "labels", "found", "exact", F.coalesce("wrong", F.lit(0)).alias("wrong"), F.coalesce("reads", F.lit(0)).alias("reads"))


def score_totals(scores: DataFrame) -> DataFrame:
    """One row: the sums over all images, and found and exact labels and wrong reads in percent."""
    sums = scores.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("labels", "found", "exact", "wrong", "reads")])
    share = lambda c, of: F.round(F.try_divide(F.col(c) * 100, F.col(of)), 1)
    return sums.select("*", share("found", "labels").alias("found_pct"), share("exact", "labels").alias("exact_pct"), share("wrong", "reads").alias("wrong_pct"))
