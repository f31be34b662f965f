"""Records that the marks of a text scan cut too often: what each split of a file begins within, and the pieces put together.

Spark's text scan cuts a file at a mark, reads it by many tasks, and gives each split's pieces in order; but a mark may stand
inside a record. Whether it does depends on all that was read before. So each split tells, in a first scan, the state that it
ends in for every state that it may begin in; these functions are composed in the order of the splits, and a second scan
reads each split from its true state. The driver composes one small row a split, of which it holds a list anyway.

Only records that reach over the end of a split are put together by a shuffle, one for each split at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.batches import in_pieces

FRAGMENT = "file string, owner long, block long, part binary"


def pieces(spark: SparkSession, path: str, mark: str, glob: str | None = None) -> DataFrame:
    """(file, block, value): the bytes between marks, with the file and where its split begins."""
    reader = spark.read.option("lineSep", mark)
    rows = (reader.option("pathGlobFilter", glob) if glob else reader).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[bytes]]]:
    """((file, block), pieces in order) of each split that a task reads."""
    rows = (((f, b), v) for batch in batches for piece in in_pieces(batch) for f, b, v in zip(*(piece.column(k).to_pylist() for k in range(3)), strict=True))
    for key, own in groupby(rows, lambda r: r[0]):
        yield key, (v for _, v in own)


def in_order(summaries: list) -> Iterator[list]:
    """The rows of each file, by the place of their split."""
    for _, own in groupby(sorted(summaries, key=lambda r: (r["file"], r["block"])), lambda r: r["file"]):
        yield list(own)


def joined(fragments: DataFrame) -> DataFrame:
    """(file, record) from rows of FRAGMENT: those without an owner are whole, the parts of each owner follow one another by block."""
    whole = fragments.filter("owner is null").select("file", F.col("part").alias("record"))
    parts = fragments.filter("owner is not null").groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("block", "part"))).alias("parts"))
    put = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["part"]))
    return whole.unionByName(parts.select("file", put.alias("record")))


def fragment_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["file", "owner", "block", "part"])


def fragments(scan: DataFrame, read: Callable[[tuple[str, int], Iterator[bytes]], Iterator[tuple[int | None, bytes]]], batch_bytes: int = 8 << 20) -> DataFrame:
    """Rows of FRAGMENT; `read` gives (owner or none, bytes) for the records of a split, and is called once for each split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for key, values in by_split(batches):
            for owner, part in read(key, values):
                rows.append((key[0], owner, key[1], part))
                size += len(part)
                if size >= batch_bytes:
                    yield fragment_batch(rows)
                    rows, size = [], 0
        yield fragment_batch(rows)

    return scan.mapInArrow(run, FRAGMENT)
