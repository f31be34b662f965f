"""Token-ID output in training order: a keyed Feistel permutation deals sequences to slots, range partitions write shards.

Texts become ids of a public byte-level vocabulary, each text followed by the end id, and are cut into sequences of
`LENGTH` ids, the last one filled up. Sequences are numbered 0 .. N-1 in the order of the input's files; the number of a
split's first sequence is a prefix sum over the splits. The slot of a sequence is a permutation of its number: a Feistel
network over the next even number of bits, keyed, walked again while its value is N or more (cycle-walking). So any slot's
place is known without a table, and another key gives another epoch's order.

Shard s holds the slots from s * SHARD on. The slots are cut into ranges of whole shards, each range goes to the partition
of its own number (`repartitionById`, so no range shares a task with another and no sample is drawn) and is sorted by slot,
and each task writes whole shards: records of one stride, a count of ids (2 bytes) and LENGTH ids of 2 bytes, little
endian. A shard is written in a folder of its attempts and then moved, and that folder is deleted with what dead attempts
left; so a task that runs again, or twice, leaves the same file. A reader finds slot i at byte (i % SHARD) * stride of
shard i // SHARD and can resume at any slot (`read_slots`).

The texts are tokenised twice, first to count, then to write: the ids are never stored in between, and the texts never
cross the network, only finished sequences do, once. Both passes must see the same splits of the input; the second checks
that each split gives as many sequences as the first counted, and fails where it does not.

Defined results: a null or empty text is one sequence of the end id alone. Repeated rows are sequences of their own. Null
ids stay null. An empty table has no slots and writes no shard. The input is a table of files; what is none, such as a
created DataFrame or the result of a join, is written as one first. Other columns are not read.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_dir, table, written

LENGTH = 512
#: Slots of a shard: 64 MiB with the stride of 1026 bytes.
SHARD = 1 << 16
END_ID = 50256
#: Splits of the input whose first numbers are broadcast, 100 bytes or so each; with more, texts are sorted by split.
SPLITS = 200_000
#: Most partitions that write; a partition takes several shards where there are more.
WRITERS = 20_000
KEY = 0x5EED
ROUNDS = 6
U64 = np.uint64


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_LOADED: dict = {}


def tokenizer(path: str):
    """One tokenizer for each worker process and file."""
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
        _LOADED[path] = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def ids_of(text: str | None, path: str) -> np.ndarray:
    ids = tokenizer(path).encode_ordinary(text.encode("utf-8", "replace").decode()) if text else []
    return np.append(np.array(ids, np.uint16), np.uint16(END_ID))


def permute(number: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """The slot of each number below n: a bijection of 0 .. n-1."""
    half = max((max(n - 1, 1).bit_length() + 1) // 2, 1)
    mask, shift = U64((1 << half) - 1), U64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for r in range(ROUNDS):
            f = right * U64(0x9E3779B97F4A7C15) + U64((key * 0xD6E8FEB86659FD93 + r * 0xC2B2AE3D27D4EB4F) % 2**64)
            f ^= f >> U64(32)
            f *= U64(0xFF51AFD7ED558CCD)
            f ^= f >> U64(29)
            left, right = right, left ^ (f & mask)
        return left << shift | right

    out = once(number.astype(np.uint64))
    while (far := out >= U64(n)).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def count_sequences(path: str, length: int):
    """(file, block, n) sums of sequences, one row for each split and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict = {}
            for f, b, t in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("text"), strict=True):
                text = t.as_py()
                total[f, b] = total.get((f, b), 0) + (len(tokenizer(path).encode_ordinary(text)) // length + 1 if text else 1)
            yield pa.RecordBatch.from_pydict({"file": [k[0] for k in total], "block": pa.array([k[1] for k in total], pa.int64()), "n": pa.array(list(total.values()), pa.int64())})

    return run


def cut(path: str, length: int, n: int, key: int, shard: int):
    """Sequences with their slots. `first` is the number of the split's first sequence and `expected` how many it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict = {}  # the splits of a task are few: the next number, and the end, of each
        for batch in batches:
            doc, chunk, number, sizes, body = [], [], [], [], []

            def full() -> pa.RecordBatch:
                slot = permute(np.array(number, np.int64), n, key)
                return pa.RecordBatch.from_arrays([pa.array(slot // shard), pa.array(slot), pa.array(doc, pa.int64()), pa.array(chunk, pa.int32()), pa.array(sizes, pa.int32()), pa.array(body, pa.binary())], names=["shard", "slot", "doc_id", "chunk", "n_tokens", "ids"])

            for d, t, f, b, first, expected in zip(batch.column("doc_id").to_pylist(), batch.column("text"), *(batch.column(c).to_pylist() for c in ("file", "block", "first", "expected")), strict=True):
                if first is None:
                    raise ValueError(f"split {b} of {f} was not counted: the splits of the two passes differ")
                ids = ids_of(t.as_py(), path)
                begin = at.get((f, b), (first, 0))[0]
                for k, lo in enumerate(range(0, len(ids), length)):
                    part = ids[lo : lo + length]
                    doc.append(d), chunk.append(k), number.append(begin + k), sizes.append(len(part)), body.append(part.tobytes())
                at[f, b] = begin + -(-len(ids) // length), first + expected
                if len(number) > 4000:
                    yield full()
                    doc, chunk, number, sizes, body = [], [], [], [], []
            if number:
                yield full()
        for split, (got, end) in at.items():
            if got != end:
                raise ValueError(f"split {split} has {got - end} sequences more than counted: the splits of the two passes differ")

    return run


def write_shards(folder: str, length: int, shard: int):
    """Writes whole shards from sequences sorted by slot; gives a row for each sequence."""
    stride = 2 + 2 * length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name = out = None

        def close() -> None:
            if out is not None:
                out.close()
                store.move(f"{root}/tries/{name}/{mark}", f"{root}/{name}")
                store.delete_dir(f"{root}/tries/{name}")

        mark = uuid.uuid4().hex
        for batch in batches:
            crc = []
            for s, k, raw in zip(batch.column("shard").to_pylist(), batch.column("n_tokens").to_pylist(), batch.column("ids"), strict=True):
                if name != f"shard-{s:08d}.bin":
                    close()
                    name = f"shard-{s:08d}.bin"
                    store.create_dir(f"{root}/tries/{name}", recursive=True)
                    out = store.open_output_stream(f"{root}/tries/{name}/{mark}")
                record = k.to_bytes(2, "little") + raw.as_py()
                out.write(record + b"\0" * (stride - len(record)))
                crc.append(zlib.crc32(raw.as_py()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("slot", "doc_id", "chunk", "n_tokens", "shard")], pa.array(crc, pa.int64())], names=["slot", "doc_id", "chunk", "n_tokens", "shard", "ids_crc32"])
        close()

    return run


def read_slots(folder: str, first: int, count: int, length: int = LENGTH, shard: int = SHARD) -> Iterator[np.ndarray]:
    """The ids in slots first .. first + count - 1, read in order."""
    stride = 2 + 2 * length
    store, root = fs.FileSystem.from_uri(folder)
    slot, end = first, first + count
    while slot < end:
        upto = min(end, (slot // shard + 1) * shard)
        with store.open_input_file(f"{root}/shard-{slot // shard:08d}.bin") as f:
            f.seek(slot % shard * stride)
            raw = np.frombuffer(f.read((upto - slot) * stride), np.uint16).reshape(-1, length + 1)
        for r in raw:
            yield r[1 : 1 + r[0]]
        slot = upto


def from_files(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs with the file, split and place of each row; docs without files are written first."""
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    where = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_block_start", "block"), ("row_index", "at"))]
    try:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *where)
    except AnalysisException:
        return written(some, "token-texts").select("doc_id", "text", *where)


def materialise(docs: DataFrame, folder: str, length: int = LENGTH, shard: int = SHARD, key: int = KEY, path: str | None = None) -> DataFrame:
    """Writes the shards to folder, a URI of a shared store, when the result is run: slot, doc_id, chunk, n_tokens, shard and ids_crc32 of each sequence. docs: doc_id and text."""
    path = path or vocabulary()
    rows = from_files(docs)
    counted = rows.select("text", "file", "block").mapInArrow(count_sequences(path, length), "file string, block long, n long")
    # a row for each split of the input, not for each text
    splits = counted.groupBy("file", "block").agg(F.sum("n").alias("expected"))
    splits = written(splits.withColumn("first", F.sum("expected").over(Window.orderBy("file", "block")) - F.col("expected")), "token-splits")
    n, many = splits.agg(F.sum("expected"), F.count("*")).first()
    n = n or 0
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    if many <= SPLITS:  # rows keep their order within a split
        placed = rows.join(F.broadcast(splits), ["file", "block"], "left")
    else:
        placed = rows.join(splits, ["file", "block"], "left").repartition("file", "block").sortWithinPartitions("file", "block", "at")
    sequences = placed.select("doc_id", "text", "file", "block", "first", "expected").mapInArrow(cut(path, length, n, key, shard), "shard long, slot long, doc_id long, chunk int, n_tokens int, ids binary")
    shards = max(-(-n // shard), 1)
    each = -(-shards // WRITERS)
    dealt = sequences.repartitionById(-(-shards // each), F.floor(F.col("shard") / each).cast("int")).sortWithinPartitions("slot")
    return dealt.mapInArrow(write_shards(folder, length, shard), "slot long, doc_id long, chunk int, n_tokens int, shard long, ids_crc32 long")


def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark)
    folder = f"{base if '://' in base else f'file://{base}'}/tokens-{uuid.uuid4().hex}"
    return materialise(table(spark, sf_dir, "documents"), folder)
