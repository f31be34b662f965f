"""Suffix-array dedup of byte strings by prefix-free parsing.

Removes every byte that a string of `SPAN` bytes covers which also starts anywhere else, in the same text or another.

1. Parse. Rolling-hash triggers cut each text into phrases: the trigger of a start is the least hash among the windows of
   `WINDOW` bytes inside the SPAN bytes that begin there, the leftmost of equal ones. Consecutive starts with one trigger
   are a phrase (the bytes of their strings). A trigger depends on the SPAN bytes alone, so equal strings lie at the same
   place of phrases with the same trigger, wherever they occur, and every string has a trigger.
2. Dictionary and parse. Phrases are dealt by trigger and sorted: equal phrases (by trigger and a 128-bit hash) are one
   dictionary entry, and the sorted occurrences are the suffix array of the parse. One phrase deep is deep enough, for an
   entry holds all bytes of the strings that start in it. Every start in an entry that occurs twice is repeated; a trigger
   with one occurrence holds no repeat. What is left are triggers with several entries.
3. Suffix array of the dictionary. The entries of such triggers, once each, are laid side by side in bounded runs of whole
   triggers, and their suffixes are sorted by prefix doubling to a depth of SPAN bytes, on the bytes themselves. Neighbours
   whose common prefix has SPAN bytes are repeats. Taken with the occurrences in the parse this is the order of the corpus
   to depth SPAN, in which a string repeats if and only if it equals a neighbour.
4. A trigger with over HOT_ENTRIES entries (a short line that a third of all texts share) is parsed again: its entries are
   cut into PIECES by the distance to the trigger, and each piece is dealt by the bytes that all its strings have in
   common, so pieces meet only where 178 bytes or more are the same. Where even these are too many, single starts are
   counted by a 128-bit hash with a partially aggregated grouping.
5. The repeated starts return to their texts, where the covered bytes are merged and removed.

Equal phrases within a batch are combined before the first shuffle, so a text with many copies sends one row for each
batch and phrase. The pass over sorted phrases holds one row of an entry at a time in effect: an entry of any count
streams through. Texts cross the network twice, compressed.

Defined results: null and empty texts, and texts of under SPAN bytes, lose nothing. Rows with the same id and text are
copies of each other like any other rows; null ids are kept. An empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, row_key, table, written

SPAN = 200
WINDOW = 24
WIDTH = SPAN - WINDOW + 1
#: Starts that one numpy pass takes; bounds memory whatever the length of a text.
CHUNK = 1 << 20
PLACE_BITS = 30
U64 = np.uint64
BASE = 0x100000001B3
#: Rows of one phrase that are held while its run is open.
HELD = 50_000
#: Bytes of phrases whose suffixes are ordered at once.
SUFFIX_BYTES = 4 << 20
#: Entries of one trigger, of up to 2 * SPAN bytes each, up to which one task takes them all; more are parsed again in so many pieces.
HOT_ENTRIES = 10_000
PIECES = 8


def power(n: int) -> np.uint64:
    return U64(pow(BASE, n, 2**64))


def mixed(data: np.ndarray) -> np.ndarray:
    h = (data.astype(np.uint64) + U64(1)) * U64(0x9E3779B97F4A7C15)
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    return h


def rolled(h: np.ndarray, have: int, want: int) -> np.ndarray:
    """Hashes of windows of `want` from those of windows of `have`; want is have times a power of two."""
    while have < want:
        longer = h[:-have] * power(have)
        longer += h[have:]
        h, have = longer, have * 2
    return h


def triggers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the window at each place, place of the trigger of each start) of a run of bytes of SPAN or more."""
    h8 = rolled(mixed(data), 1, 8)
    h = h8[:-16] * power(16)
    h += h8[8:-8] * power(8)
    h += h8[16:]
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    m, starts = len(h), len(data) - SPAN + 1
    blocks = -(-m // WIDTH)
    keyed = np.full(blocks * WIDTH, U64(2**64 - 1))
    keyed[:m] = (h >> U64(PLACE_BITS)) << U64(PLACE_BITS) | np.arange(m, dtype=np.uint64)
    keyed = keyed.reshape(blocks, WIDTH)
    ahead = np.minimum.accumulate(keyed, axis=1).ravel()
    behind = np.minimum.accumulate(keyed[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:starts], ahead[WIDTH - 1 : WIDTH - 1 + starts])
    return h, (least & U64((1 << PLACE_BITS) - 1)).astype(np.int64)


def parse(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first start in its text, number of starts, trigger's place from the first start, trigger, two halves of the phrase hash) of all phrases."""
    total = len(data)
    ends = begin + size
    for lo in range(0, max(total - SPAN + 1, 0), CHUNK):
        part = data[lo : lo + CHUNK + SPAN - 1]
        h, at = triggers(part)
        n = len(at)
        starts = np.arange(lo, lo + n)
        text = np.searchsorted(ends, starts, side="right")
        valid = starts + SPAN <= ends[np.minimum(text, len(ends) - 1)]
        new = np.ones(n, bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
        last = np.ones(n, bool)
        last[:-1] = new[1:] | ~valid[1:]
        a, b = np.flatnonzero(new & valid), np.flatnonzero(last & valid)
        if len(a):
            view = memoryview(np.ascontiguousarray(part))
            phrase = digests(view[i:j] for i, j in zip(a.tolist(), (b + SPAN).tolist(), strict=True))
            yield text[a], starts[a] - begin[text[a]], b - a + 1, at[a] - a, h[at[a]], phrase[:, 0], phrase[:, 1]


def digests(pieces) -> np.ndarray:
    """The 128-bit hashes of byte strings, as two columns."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, pieces)), np.int64).reshape(-1, 2)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, begin, size) of a string column; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(offsets) else np.zeros(0, np.uint8)
    return data, offsets[:-1] - offsets[0], np.diff(offsets)


PHRASE = pa.schema([("key", pa.int64()), ("phrase", pa.int64()), ("phrase2", pa.int64()), ("_k", pa.int64()), ("_h", pa.int64()), ("place", pa.int64())])
#: place packs the first start, the number of starts (20 bits), the place of the trigger (10) and a flag (2: 1 for one of several, 2 for settled).


def pack(first, n, trigger, flag):
    return ((first.astype(np.int64) << 20 | n) << 10 | trigger) << 2 | flag


def unpack(place: np.ndarray) -> tuple[np.ndarray, ...]:
    return place >> 32, place >> 12 & 1023, place >> 2 & 1023, place & 3


def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, begin, size = utf8(batch.column("text"))
        k, h = batch.column("_k").to_numpy(), batch.column("_h").to_numpy()
        for text, first, n, at, trigger, phrase, phrase2 in parse(data, begin, size):
            order = np.lexsort((phrase2, phrase, trigger))
            t, p, q = trigger[order], phrase[order], phrase2[order]
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
            many = np.diff(np.append(np.flatnonzero(new), len(t)))[np.cumsum(new) - 1] > 1
            flag = np.where(many, np.where(new, 1, 2), 0)
            text, first, n, at = text[order], first[order], n[order], at[order]
            # settled rows are dealt evenly, by their own text and place
            key = np.where(flag == 2, (h[text] ^ (k[text] + first) * -7046029254386353131), t.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.where(flag == 2, 0, p)), pa.array(np.where(flag == 2, 0, q)), pa.array(k[text]), pa.array(h[text]), pa.array(pack(first, n, at, flag))], schema=PHRASE)


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From phrases sorted by trigger and phrase: rows that repeat (kind 1), and one row for each entry of a trigger with several (kind 2; 3 is both)."""
    fields = ("key", "phrase", "phrase2", "_k", "_h", "place")
    held = {f: np.zeros(0, np.int64) for f in fields}
    branched: int | None = None  # the trigger that is known to have several entries, if it is the open one

    def emit(rows: dict, keep: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(rows[f][keep]) for f in ("key", "_k", "_h", "place")] + [pa.array(kind[keep].astype(np.int32))], names=["key", "_k", "_h", "place", "kind"])

    def work(rows: dict, final: bool) -> tuple[pa.RecordBatch | None, dict]:
        nonlocal branched
        key, phrase, flag = rows["key"], rows["phrase"], rows["place"] & 3
        n = len(key)
        if not n:
            return None, rows
        new_key = np.ones(n, bool)
        new_key[1:] = key[1:] != key[:-1]
        new = new_key.copy()
        new[1:] |= (phrase[1:] != phrase[:-1]) | (rows["phrase2"][1:] != rows["phrase2"][:-1])
        first = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        size = np.diff(np.append(first, n))
        several = (size > 1) | (np.maximum.reduceat(flag, first) == 1)
        entries = np.bincount((np.cumsum(new_key) - 1)[first])[np.cumsum(new_key) - 1] > 1
        if branched is not None and key[0] == branched:
            entries |= key == branched
        kind = several[run].astype(np.int64) + 2 * (entries & new)
        kind[flag == 2] = 1
        if final:
            return emit(rows, kind > 0, kind), {}
        cut = first[-1]  # the last run is open
        branched = int(key[-1]) if entries[-1] else None
        keep = kind > 0
        rest = slice(cut, None)
        if n - cut > HELD:  # its first row stays for the entry, the others repeat
            kind[cut + 1 :] = 1
            keep[cut + 1 :] = True
            keep[cut] = False
            rows["place"] = rows["place"].copy()
            rows["place"][cut] |= 1
            rest = slice(cut, cut + 1)
        else:
            keep[cut:] = False
        return emit(rows, keep, kind), {f: rows[f][rest] for f in fields}

    for batch in batches:
        out, held = work({f: np.concatenate([held[f], batch.column(f).to_numpy()]) for f in fields}, False)
        if out is not None and out.num_rows:
            yield out
    out, _ = work(held, True) if held else (None, None)
    if out is not None and out.num_rows:
        yield out


def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, for the network."""
    for batch in batches:
        z = zstandard.ZstdCompressor(level=1)
        data, begin, size = utf8(batch.column("text"))
        view = memoryview(data)
        packed = [z.compress(view[b : b + s]) for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_k"), batch.column("_h"), pa.array(packed, pa.binary())], names=["doc_id", "_k", "_h", "z"])


ENTRY = pa.schema([("key", pa.int64()), ("_k", pa.int64()), ("_h", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("at", pa.int64()), ("flag", pa.int64()), ("bytes", pa.binary())])
ENTRY_DDL = "key long, _k long, _h long, start long, n long, at long, flag long, bytes binary"
#: Of an entry or piece: its first start in its text, how many starts, the place of the trigger from the first, 1 if it is known to repeat plus 2 if its trigger is hot, and the bytes of all its strings.


def cut_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted dictionary entries of each text."""
    for batch in batches:
        z = zstandard.ZstdDecompressor()
        keys, places, owners, pieces = [], [], [], []

        def flush(batch=batch) -> pa.RecordBatch:
            own = pa.array(owners, pa.int64())
            first, n, at, flag = unpack(np.array(places, np.int64))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column("_k").take(own), batch.column("_h").take(own), *map(pa.array, (first, n, at, flag)), pa.array(pieces, pa.binary())], schema=ENTRY)

        for i, (packed, wanted) in enumerate(zip(batch.column("z"), batch.column("entries"), strict=True)):
            data = z.decompress(packed.as_py())
            for w in wanted.values.to_pylist():
                first, n = w["place"] >> 32, w["place"] >> 12 & 1023
                keys.append(w["key"]), places.append(w["place"]), owners.append(i)
                pieces.append(data[first : first + n + SPAN - 1])
            if len(pieces) > 20_000:
                yield flush()
                keys, places, owners, pieces = [], [], [], []
        if pieces:
            yield flush()


def suffix_classes(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The places of the strings of SPAN bytes that equal another one, by a suffix array to this depth.

    left: for each byte how many there are up to the end of its entry, itself included. The suffixes are sorted by their
    first 8 bytes and then by prefix doubling (Larsson and Sadakane): the rank of a suffix is the place of the first that is
    equal so far, and only those that share it are sorted on, by the rank of what follows.
    """
    n = len(data)
    head = np.zeros(n, np.uint64)
    padded = np.append(data, np.zeros(8, np.uint8)).astype(np.uint64)
    for k in range(8):
        head = head << U64(8) | padded[k : k + n]
    order = np.argsort(head)
    rank = np.empty(n, np.int64)
    active, key, depth = np.arange(n), head[order], 8
    while True:
        new = np.ones(len(active), bool)
        new[1:] = key[1:] != key[:-1]
        rank[order[active]] = active[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        alone = new & np.append(new[1:], True)
        active = active[~alone]
        if depth == SPAN or not len(active):
            return order[active]
        step = min(depth, SPAN - depth)
        depth += step
        active = active[left[order[active]] >= depth]  # nothing that is looked for needs the others any more
        suffix = order[active]
        key = rank[suffix] << 32 | rank[suffix + step]
        sort = np.argsort(key, kind="stable")
        order[active], key = suffix[sort], key[sort]


def equal_suffixes(rows: pa.Table) -> pa.RecordBatch:
    """The runs of starts of entries that equal another start; those of entries that are known to repeat are left out."""
    first, n, flag = (rows.column(c).to_numpy() for c in ("start", "n", "flag"))
    pieces = rows.column("bytes").to_pylist()
    size = n + SPAN - 1
    begin = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(n)), size)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    twice = np.sort(suffix_classes(data, (begin + size)[owner] - np.arange(len(data))))
    twice = twice[flag[owner[twice]] & 1 == 0]
    opens = np.ones(len(twice), bool)
    opens[1:] = (twice[1:] != twice[:-1] + 1) | (owner[twice[1:]] != owner[twice[:-1]])
    closes = np.append(opens[1:], True)[: len(twice)]
    a, b = twice[opens], twice[closes]
    e = owner[a]
    return pa.RecordBatch.from_arrays([pa.array(rows.column("_k").to_numpy()[e]), pa.array(rows.column("_h").to_numpy()[e]), pa.array(first[e] + a - begin[e]), pa.array(b - a + 1)], names=["_k", "_h", "start", "n"])


def order_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by key, whole keys at once, of about SUFFIX_BYTES together; a key has no more than HOT_ENTRIES."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        total += batch.nbytes
        if total >= SUFFIX_BYTES:
            rows = pa.Table.from_batches(held).combine_chunks()
            key = rows.column("key").to_numpy()
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            sizes = np.cumsum(rows.column("n").to_numpy() + SPAN - 1)
            lo = 0
            while lo < (cuts[-1] if len(cuts) else 0):  # the last key is open
                far = cuts[cuts > lo]
                fit = far[sizes[far - 1] - (sizes[lo - 1] if lo else 0) <= SUFFIX_BYTES]
                hi = int(fit[-1]) if len(fit) else int(far[0])
                yield equal_suffixes(rows.slice(lo, hi - lo))
                lo = hi
            held = rows.slice(lo).combine_chunks().to_batches()
            total = sum(b.nbytes for b in held)
    if held:
        yield equal_suffixes(pa.Table.from_batches(held).combine_chunks())


def cut_pieces(count: int):
    """Cuts entries of hot triggers into pieces, dealt by the bytes that all strings of a piece hold; with count WIDTH, single starts."""
    width = -(-WIDTH // count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                rows = batch.slice(lo, 2000)
                owners, starts, sizes, ats, common, pieces = [], [], [], [], [], []
                for i, (first, n, at, raw) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("start", "n", "at", "bytes")), strict=True)):
                    o = 0
                    while o < n:  # starts by their distance to the trigger, at - o
                        part = (at - o) // width
                        upto = min(n, at - part * width + 1)
                        near, far = part * width, min(part * width + width - 1, WIDTH - 1)
                        owners.append(i), starts.append(first + o), sizes.append(upto - o), ats.append(at - o)
                        pieces.append(raw[o : upto + SPAN - 1])
                        # all strings of the part hold the bytes from near before the trigger to SPAN - far after it
                        common.append(part.to_bytes(2, "little") + raw[at - near : at + SPAN - far])
                        o = upto
                own = pa.array(owners, pa.int64())
                key = rows.column("key").to_numpy()[owners] ^ digests(common)[:, 0] if owners else np.zeros(0, np.int64)
                flag = rows.column("flag").to_numpy()[owners] & 1 if owners else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), rows.column("_k").take(own), rows.column("_h").take(own), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ats, pa.int64()), pa.array(flag), pa.array(pieces, pa.binary())], schema=ENTRY)

    return run


def single_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each start: the 128-bit hash of its string, and whether its entry is known to repeat."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 1000):
            rows = batch.slice(lo, 1000)
            n = rows.column("n").to_numpy()
            entry = np.repeat(np.arange(len(n)), n)
            offset = np.arange(len(entry)) - np.repeat(np.cumsum(n) - n, n)
            views = [memoryview(b) for b in rows.column("bytes").to_pylist()]
            mark = digests(views[e][o : o + SPAN] for e, o in zip(entry.tolist(), offset.tolist(), strict=True))
            k, h, start, flag = (rows.column(c).to_numpy()[entry] for c in ("_k", "_h", "start", "flag"))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (mark[:, 0], mark[:, 1], k, h, start + offset, flag & 1 == 1)], names=["print", "print2", "_k", "_h", "start", "known"])


def ordered(entries: DataFrame) -> DataFrame:
    return entries.repartition("key").sortWithinPartitions("key").mapInArrow(order_suffixes, "_k long, _h long, start long, n long")


def with_hot(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(entries of other keys, entries of keys with over HOT_ENTRIES)."""
    hot = written(entries.groupBy("key").agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT_ENTRIES).select("key"), "repeats-hot")
    return entries.join(hot, "key", "left_anti"), entries.join(hot, "key", "left_semi")


def repeats_of_hot(entries: DataFrame) -> DataFrame:
    """As order_suffixes, for triggers with any number of entries."""
    pieces = written(entries.mapInArrow(cut_pieces(PIECES), ENTRY_DDL), "repeats-pieces")
    few, many = with_hot(pieces)
    starts = many.mapInArrow(single_starts, "print long, print2 long, _k long, _h long, start long, known boolean")
    twice = starts.groupBy("print", "print2").agg(F.count("*").alias("rows")).filter("rows > 1").drop("rows")
    single = starts.filter(~F.col("known")).join(twice, ["print", "print2"], "left_semi").select("_k", "_h", "start", F.lit(1).cast("long").alias("n"))
    return ordered(few).unionByName(single)


def remove(data: bytes, spans: np.ndarray) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs of them, what is left) for repeated starts given as (first, number) rows."""
    if not len(spans):
        return 0, 0, data
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, spans[:, 0], 1)
    np.add.at(change, spans[:, 0] + spans[:, 1] + SPAN - 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()


def spans_of(starts: pa.ListScalar) -> np.ndarray:
    if not starts.is_valid or not len(starts.values):
        return np.zeros((0, 2), np.int64)
    return np.stack([starts.values.field("start").to_numpy(), starts.values.field("n").to_numpy()], 1)


def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        z = zstandard.ZstdDecompressor()
        cols: list[list] = [[], [], [], []]
        for packed, starts in zip(batch.column("z"), batch.column("starts"), strict=True):
            data = z.decompress(packed.as_py())
            removed, runs, rest = remove(data, spans_of(starts))
            for c, v in zip(cols, (len(data), removed, runs, hashlib.sha256(rest).hexdigest()), strict=True):
                c.append(v)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        z = zstandard.ZstdDecompressor()
        kept = [remove(z.decompress(p.as_py()), spans_of(s))[2] for p, s in zip(batch.column("z"), batch.column("starts"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())], names=["doc_id", "text"])


def repeated_starts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(packed, starts): doc_id, _k, _h and the compressed text z of each row; for each _k, _h the repeated starts, as an array of (start, n)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *row_key(key, text))
    found = rows.select("_k", "_h", "text").mapInArrow(phrases, "key long, phrase long, phrase2 long, _k long, _h long, place long")
    settled = found.repartition("key").sortWithinPartitions("key", "phrase", "phrase2").mapInArrow(settle, "key long, _k long, _h long, place long, kind int")
    settled = written(settled, "repeats-settled")
    packed = rows.mapInArrow(squeeze, "doc_id long, _k long, _h long, z binary")
    wanted = settled.filter(F.col("kind") >= 2).withColumn("place", F.col("place").bitwiseAND(F.lit(~3)) + F.when(F.col("kind") == 3, 1).otherwise(0))
    hot = written(wanted.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_ENTRIES).select("key", F.lit(2).alias("hot")), "repeats-hot")
    any_hot = not hot.isEmpty()
    if any_hot:
        wanted = wanted.join(hot, "key", "left").withColumn("place", F.col("place") + F.coalesce("hot", F.lit(0)))
    entries = wanted.groupBy("_k", "_h").agg(F.collect_set(F.struct("key", "place")).alias("entries"))
    # rows of equal id and text are cut once, for an entry stands for all its places
    cut = packed.select("_k", "_h", "z").dropDuplicates(["_k", "_h"]).join(entries, ["_k", "_h"])
    every = cut.select("_k", "_h", "z", "entries").mapInArrow(cut_entries, ENTRY_DDL)
    if any_hot:
        every = written(every, "repeats-entries")
        partly = ordered(every.filter("flag < 2")).unionByName(repeats_of_hot(every.filter("flag >= 2")))
    else:
        partly = ordered(every)
    whole = settled.filter(F.col("kind").isin(1, 3)).select("_k", "_h", F.shiftright("place", 32).alias("start"), F.shiftright("place", 12).bitwiseAND(F.lit(1023)).alias("n"))
    starts = whole.unionByName(written(partly, "repeats-partly")).groupBy("_k", "_h").agg(F.collect_set(F.struct("start", "n")).alias("starts"))
    if any_hot:
        discard(every)
    return packed, starts


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text without the repeated bytes; where a cut splits a character, its rest becomes U+FFFD."""
    packed, starts = repeated_starts(docs, key, text)
    return packed.join(starts, ["_k", "_h"], "left").select("doc_id", "z", "starts").mapInArrow(strip, "doc_id long, text string")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed, starts = repeated_starts(table(spark, sf_dir, "documents"))
    rows = packed.join(starts, ["_k", "_h"], "left").select("doc_id", "z", "starts")
    return rows.mapInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
