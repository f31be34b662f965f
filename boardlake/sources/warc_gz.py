"""A data source for compressed web archives: `spark.read.format("warc_gz")` reads one file by many tasks.

Each record is a member of the gzip file, and members can be read by themselves. A task takes the members that begin in its
range of bytes: the first is where a gzip head stands and a whole member with the right checksum follows, and each of the
others begins where the one before ends. A file that is one member is read by the task that holds its beginning.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from boardlake.functions.scratch import arrow_files

#: What every record begins with, what its head ends with, and how a gzip member begins; fixed values.
MARK, GAP, MAGIC = b"WARC/1.0\r\n", b"\r\n\r\n", b"\x1f\x8b\x08"
LENGTH = re.compile(rb"^Content-Length:\s*(\d+)", re.IGNORECASE | re.MULTILINE)
CHUNK, INFLATED = 1 << 18, 1 << 22


def needed(record: bytes | bytearray) -> int | None:
    """How many bytes of a record, counted after its mark, its head asks for; None if the head has no end or no length."""
    end = record.find(GAP)
    m = LENGTH.search(record[:end]) if end >= 0 else None
    return end + len(GAP) + int(m[1]) if m else None


def member(file, at: int) -> Iterator[tuple[int, bytes]]:
    """(next member's place or 0, data) of the member at a place of a file; an error if it is none or damaged."""
    file.seek(at)
    inflate = zlib.decompressobj(31)
    while data := file.read(CHUNK):
        at += len(data)
        while data:
            out = inflate.decompress(data, INFLATED)
            data = inflate.unconsumed_tail
            yield (at - len(inflate.unused_data) if inflate.eof else 0), out
            if inflate.eof:
                return
    raise zlib.error("the file ends inside a member")


def first_member(file, start: int, end: int) -> int | None:
    """The place of the first whole member that begins in [start, end)."""
    at = start
    while at < end:
        file.seek(at)
        data = file.read(min(CHUNK, end - at) + len(MAGIC) - 1)
        found = data.find(MAGIC)
        if found < 0:
            at += max(len(data) - len(MAGIC) + 1, 1)
            continue
        try:
            head = b""
            for _, part in member(file, at + found):
                head = head or part
            if head.startswith(MARK[: len(head)]):
                return at + found
        except zlib.error:
            pass
        at += found + 1
    return None


def records(file, start: int, end: int) -> Iterator[bytes]:
    """The records, without their marks, of the members that begin in [start, end). A member that begins with the mark begins a
    record, unless the one before still asks for bytes; one that doesn't goes on with the record before. A damaged member ends
    its record, and the next whole one is read on."""
    at, size, held = first_member(file, start, end), file.size(), bytearray()
    while at is not None and at < size:
        after, begun = 0, False
        try:
            for after, part in member(file, at):  # noqa: B007
                if part and not begun:
                    begun = True
                    if part.startswith(MARK) and (needed(held[len(MARK) :]) or 0) <= max(len(held) - len(MARK), 0):
                        yield from rest(held)
                        held = bytearray()
                        if at >= end:
                            return
                held += part
                yield from whole(held)
        except zlib.error:
            yield from rest(held)
            held, after = bytearray(), first_member(file, at + 1, end)
        at = after
    yield from rest(held)


def whole(held: bytearray) -> Iterator[bytes]:
    """Takes from the beginning of held the records that are surely whole: those with a length, and with the next mark behind them."""
    while held.startswith(MARK):
        need = needed(held[len(MARK) : len(MARK) + 65536])
        after = -1 if need is None else held.find(MARK, len(MARK) + need, len(MARK) + need + 64)
        if after < 0:
            return
        yield bytes(held[len(MARK) : after])
        del held[:after]


def rest(held: bytearray) -> Iterator[bytes]:
    """What is left at the end of a record's members; records without a length end at the next mark."""
    yield from whole(held)
    while held.startswith(MARK):
        need = needed(held[len(MARK) :])
        after = held.find(MARK, len(MARK) + (need or 0))
        after = len(held) if after < 0 else after
        yield bytes(held[len(MARK) : after])
        del held[:after]


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int


class Reader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[Range]:
        files, path = arrow_files(self.path)
        info = files.get_file_info(path)
        found = files.get_file_info(fs.FileSelector(path)) if info.type == fs.FileType.Directory else [info]
        found = sorted((f for f in found if f.is_file and f.path.endswith(".gz")), key=lambda f: f.path)
        return [Range(f.path, at, min(at + self.split, f.size)) for f in found for at in range(0, f.size, self.split)] or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files, _ = arrow_files(self.path)
        with files.open_input_file(partition.path) as file:
            for record in records(file, partition.start, partition.end):
                yield pa.RecordBatch.from_arrays([pa.array([partition.path]), pa.array([record], pa.binary())], names=["file", "record"])


class WarcGz(DataSource):
    """Options: path (a file, or a folder with files that end in .gz) and split, the bytes of a range (64 MiB)."""

    @classmethod
    def name(cls) -> str:
        return "warc_gz"

    def schema(self) -> str:
        return "file string, record binary"

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], int(self.options.get("split", 64 << 20)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcGz)
