"""Cross-tokenizer alignment by inverted pair bitmaps: which tokens of one vocabulary stand for which of another.

Each text, with a blank before it, is encoded by both tokenizers. Where a token of either ends at the same byte, a group ends;
the tokens of A and of B within a group are linked, each with each. Tasks number their documents within blocks of at most
`BLOCK_LINKS` links and 65,536 documents, and invert each block: for every pair of ids one compressed bitmap of the block's
documents that hold it linked (all links of a pair merged; sorted 16-bit places, or a plain bitmap where that is shorter), its
size counted, and planes of its multiplicities less one, bit by bit. The parts are written once. Bitmaps of a pair in other
blocks have other documents, so the counts of documents and links of a pair are sums over blocks, with one number from each.
The postings then meet these counts and go back to their block, where each returns its pair's count to the documents in it.

A text is encoded by units that end before a blank or line feed after something else than white space. No token of either
vocabulary spans such a place (A never joins white space to what stands before it; that no piece of B has a blank after
another letter, or a line feed, is checked when it is loaded), so tokens and groups of a unit are the same anywhere. They
are kept for up to `CACHE` units, on which no result depends.

Defined results: null and empty texts, and texts whose tokens do not spell the blank and the text (U+2581 becomes a blank in
B), have no tokens: zeros and an empty digest. Repeated rows and ids, and null ids, are rows of their own, and count as
documents each. Other columns are not read; an empty table gives an empty result. The vocabulary files must be at the same
path on all executors.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import RARE, byte_letters
from .common import table, written

BLOCK_LINKS, BLOCK_DOCS = 1 << 22, 1 << 16
CACHE, LONG, STEP = 400_000, 200, 1 << 20
UNIT = re.compile(r"\s*+(?:\S++(?:[^\S \n]\s*+)?+)*+")
#: How byte-level BPE cuts a text before it merges; fixed value.
WORDS_OF_A = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STATS = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
PARTS = "block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a int, b int, n_docs long, docs binary, planes binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def vocabularies() -> tuple[str, str]:
    """The places of the default vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class ByteBpe:
    """Ids of A for many units at once. The ranks and the pattern come from the vocabulary file; units with letters whose class
    depends on the Unicode version, and those that end in white space, are encoded by the file's own library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        special = {t.content for t in self.own.get_added_tokens_decoder().values()}
        ranks = {bytes(map(byte_of.__getitem__, s)): i for s, i in self.own.get_vocab(with_added_tokens=True).items() if s not in special}
        with open(path) as f:
            merges = json.load(f)["model"]["merges"]
        merged = [bytes(map(byte_of.__getitem__, "".join(m if isinstance(m, list) else m.split(" ")))) for m in merges]
        #: Whether ids are ranks: then the merge with the least id is the first one of the file.
        self.ranked = len(ranks) == 256 + len(merged) and all(ranks[m] == 256 + k for k, m in enumerate(merged))
        self.fast = tiktoken.Encoding("a", pat_str=WORDS_OF_A, mergeable_ranks=ranks, special_tokens={}) if self.ranked else None
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.size[list(ranks.values())] = [len(k) for k in ranks]

    def encode(self, units: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, one after the other, and how many each has. sizes: their bytes."""
        slow = [k for k, u in enumerate(units) if self.fast is None or u[-1].isspace() or RARE.search(u)]
        counts, found = np.zeros(len(units), np.int64), {}
        for k, e in zip(slow, self.own.encode_batch([units[k] for k in slow], add_special_tokens=False), strict=True):
            found[k] = e.ids
            counts[k] = len(e.ids)
        fast = np.delete(np.arange(len(units)), slow)
        ids = np.array(self.fast.encode_ordinary("".join([units[k] for k in fast])) if len(fast) else [], np.int64)
        counts[fast] = np.diff(np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(sizes[fast])) + 1, prepend=0)
        if not slow:
            return ids, counts
        out, owner = np.zeros(counts.sum(), np.int64), np.repeat(np.arange(len(units)), counts)
        own = np.zeros(len(units), bool)
        own[slow] = True
        out[~own[owner]] = ids
        out[own[owner]] = [i for k in slow for i in found[k]]
        return out, counts


class Aligner:
    """Tokens, groups and linked pairs of units of text."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a, self.b = ByteBpe(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any("\n" in p or re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece of B spans a place where texts are cut into units")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_size = np.array(list(map(len, self.b_bytes)))
        #: How an id is shown before another of its group, before B's of its group, before the next group, and last.
        self.signs = [f"{i}{sign}" for sign in ",|;" for i in range(max(len(self.a.size), len(pieces)))] + [str(i) for i in range(len(pieces))]
        self.forget()

    def forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.shown: list[str | None] = []
        self.sizes = np.zeros((0, 4), np.int64)
        self.first, self.pairs = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def spelled(self, units: list[str], b: np.ndarray, b_end: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether B's tokens spell each unit, from where its tokens and bytes end among all."""
        text, found = "".join(units).encode(), b"".join(map(self.b_bytes.__getitem__, b.tolist()))
        found_end = np.append(0, np.cumsum(self.b_size[b]))[b_end]
        if text == found and (found_end == end).all():
            return np.ones(len(units), bool)
        cuts = zip(np.append(0, end[:-1]).tolist(), end.tolist(), np.append(0, found_end[:-1]).tolist(), found_end.tolist(), strict=True)
        return np.array([text[p:q] == found[x:y] for p, q, x, y in cuts], bool)

    def learn(self, units: list[str]) -> None:
        size = np.fromiter((len(u.encode()) for u in units), np.int64, len(units))
        a, n_a = self.a.encode(units, size)
        # a line feed before the unit keeps the blank that B adds by itself apart from it
        lists = [ids[2:] for ids in self.b.encode(["\n" + u for u in units], num_threads=1)]
        n_b, b = np.fromiter(map(len, lists), np.int64, len(units)), np.array(list(chain.from_iterable(lists)), np.int64)
        fits = self.spelled(units, b, np.cumsum(n_b), np.cumsum(size))
        unit_a, unit_b = np.repeat(np.arange(len(units)), n_a), np.repeat(np.arange(len(units)), n_b)
        if not fits.all():
            a, b, unit_a, unit_b = a[fits[unit_a]], b[fits[unit_b]], unit_a[fits[unit_a]], unit_b[fits[unit_b]]
        # tokens that fit end at the same bytes as if all units were one text; a group ends where both do
        a_end, b_end = np.cumsum(self.a.size[a]), np.cumsum(self.b_size[b])
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        group_a, group_b = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        unit_of = unit_a[np.cumsum(in_a) - 1]  # by group
        last_a, last_b = np.append(np.diff(group_a) > 0, True)[: len(a)], np.append(np.diff(group_b) > 0, True)[: len(b)]
        last_of_unit = np.append(np.diff(unit_b) > 0, True)[: len(b)]
        width = max(len(self.a.size), len(self.b_bytes))
        sign = np.concatenate([a + width * last_a, b + width * (2 * last_b + last_of_unit)])
        order = np.argsort(np.concatenate([group_a, group_b]), kind="stable")
        parts = list(map(self.signs.__getitem__, sign[order].tolist()))
        upto = np.cumsum(np.bincount(unit_a, minlength=len(units)) + np.bincount(unit_b, minlength=len(units))).tolist()
        shown, lo = [], 0
        for hi, fit in zip(upto, fits.tolist(), strict=True):
            shown.append("".join(parts[lo:hi]) if fit else None)
            lo = hi
        # each token of A with each of B in its group
        many = in_b[group_a]
        right = np.repeat((np.cumsum(in_b) - in_b)[group_a] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        pairs = np.repeat(a, many) << 20 | b[right]
        links = np.bincount(unit_a, many, len(units)).astype(np.int64)
        groups = np.bincount(unit_of, minlength=len(units))
        self.ids.update(zip(units, range(len(self.ids), len(self.ids) + len(units)), strict=True))
        self.shown += shown
        self.sizes = np.concatenate([self.sizes, np.stack([n_a, n_b, groups, links], 1)])
        self.first = np.concatenate([self.first, np.cumsum(links) + len(self.pairs)])
        self.pairs = np.concatenate([self.pairs, pairs])

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of each text the number of A's and B's tokens, groups and links, and a digest; of each link its text and pair."""
        rows = [[u for u in UNIT.findall(" " + t) if u] if t else [] for t in texts]
        every = set().union(*rows)
        new = every - self.ids.keys()
        if len(self.ids) + len(new) > CACHE:
            self.forget()
            new = every
        if new:
            self.learn(list(new))
        out, digests, kept = np.zeros((len(texts), 4), np.int64), [], []
        for k, units in enumerate(rows):
            places = list(map(self.ids.__getitem__, units))
            shown = list(map(self.shown.__getitem__, places))
            if not places or None in shown:
                digests.append("")
                kept.append(np.zeros(0, np.int64))
                continue
            digests.append(hashlib.sha256(";".join(shown).encode()).hexdigest())
            kept.append(np.array(places))
            out[k] = self.sizes[kept[-1]].sum(0)
        unit = np.concatenate(kept) if kept else np.zeros(0, np.int64)
        n = self.first[unit + 1] - self.first[unit]
        at = np.repeat(self.first[unit] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(unit) else unit
        pair = self.pairs[at]
        if any(len(u) > LONG for u in new):
            self.forget()
        return out, digests, np.repeat(np.arange(len(texts)), out[:, 3]), pair


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One aligner for each worker process and pair of files."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def packed(places: np.ndarray) -> bytes:
    """A set of 16-bit places: sorted places, or after a byte 1 a plain bitmap where that is shorter."""
    plain = int(places[-1]) // 8 + 1
    if plain >= 2 * len(places):
        return b"\0" + places.astype("<u2").tobytes()
    bits = np.zeros(8 * plain, bool)
    bits[places] = True
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if data[0]:
        return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))
    return np.frombuffer(data, "<u2", offset=1)


def planes_of(times: np.ndarray) -> bytes:
    """Bit planes of multiplicities less one, lowest first; none if all are one."""
    left, out = times - 1, []
    while left.any():
        out.append(np.packbits(left & 1).tobytes())
        left = left >> 1
    return b"".join(out)


def times_of(planes: bytes, n: int) -> np.ndarray:
    size = (n + 7) // 8
    bits = np.unpackbits(np.frombuffer(planes, np.uint8).reshape(-1, size), axis=1)[:, :n].astype(np.int64)
    return 1 + (bits << np.arange(len(bits))[:, None]).sum(0)


def postings(block: int, place: np.ndarray, pair: np.ndarray) -> pa.RecordBatch | None:
    """One row for each pair of a block: its bitmap of documents and its planes."""
    if not len(pair):
        return None
    key, times = np.unique(pair << 16 | place, return_counts=True)
    pair, place = key >> 16, key & 0xFFFF
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    ends = np.append(first[1:], len(pair))
    repeated = np.maximum.reduceat(times, first) > 1
    docs = [packed(place[lo:hi]) for lo, hi in zip(first.tolist(), ends.tolist(), strict=True)]
    planes = [planes_of(times[lo:hi]) if many else b"" for lo, hi, many in zip(first.tolist(), ends.tolist(), repeated.tolist(), strict=True)]
    n, schema = len(first), arrow_schema(PARTS)
    have = {
        "block": pa.array(np.full(n, block)), "a": pa.array((pair[first] >> 20).astype(np.int32)), "b": pa.array((pair[first] & 0xFFFFF).astype(np.int32)),
        "n_docs": pa.array(ends - first), "n_links": pa.array(np.add.reduceat(times, first)), "docs": pa.array(docs), "planes": pa.array(planes),
    }
    return pa.RecordBatch.from_arrays([have.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)


def pair_index(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """The written parts of the index: a row for each document (a is null) and one for each pair of each block."""
    a_path, b_path = paths or vocabularies()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, schema = aligner(a_path, b_path), arrow_schema(PARTS)
        block, n_docs, n_links, places, pairs = TaskContext.get().partitionId() << 32, 0, 0, [], []
        for batch in batches:
            texts, lo, size = batch.column("text").to_pylist(), 0, 0
            for hi in range(1, len(texts) + 1):
                size += len(texts[hi - 1] or "")
                if size < STEP and hi - lo < 2000 and hi < len(texts):
                    continue
                if places and (n_links >= BLOCK_LINKS or n_docs + hi - lo > BLOCK_DOCS):
                    yield postings(block, np.concatenate(places), np.concatenate(pairs)) or pa.RecordBatch.from_pylist([], schema)
                    block, n_docs, n_links, places, pairs = block + 1, 0, 0, [], []
                stats, digests, owner, pair = tool.align(texts[lo:hi])
                have = dict(zip(STATS[1:], map(pa.array, stats.T.copy()), strict=True))
                have |= {"block": pa.array(np.full(hi - lo, block)), "place": pa.array(np.arange(n_docs, n_docs + hi - lo, dtype=np.int32)), "doc_id": batch.column("doc_id").slice(lo, hi - lo), "groups_sha256": pa.array(digests, pa.string())}
                yield pa.RecordBatch.from_arrays([have.get(f.name, pa.nulls(hi - lo, f.type)) for f in schema], schema=schema)
                places.append(owner + n_docs)
                pairs.append(pair)
                n_docs, n_links, lo, size = n_docs + hi - lo, n_links + len(pair), hi, 0
        if places and (last := postings(block, np.concatenate(places), np.concatenate(pairs))):
            yield last

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(rows.mapInArrow(run, PARTS), "alignment-parts")


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links, is_best): of each linked pair of ids the documents that hold it and its links; is_best where no other pair of a has more documents."""
    pairs = index.filter("a is not null").groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    pairs = written(pairs, "alignment-pairs")
    return pairs.join(pairs.groupBy("a").agg(F.max("n_docs").alias("_most")), "a").select("a", "b", "n_docs", "n_links", (F.col("n_docs") == F.col("_most")).alias("is_best"))


def returned(docs: pa.Table, parts: pa.Table) -> pa.Table:
    """The rows of a block's documents, with what the postings of its pairs return to them."""
    n_best, total = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
    columns = (parts.column(c).to_pylist() for c in ("docs", "planes", "n_docs", "count", "is_best"))
    for data, planes, n, count, best in zip(*columns, strict=True):
        place = unpacked(data)
        times = times_of(planes, n) if planes else 1
        total[place] += count * times
        if best:
            n_best[place] += times
    place = docs.column("place").to_numpy()
    out = {c: docs.column(c) for c in (*STATS, "groups_sha256")} | {"n_best": pa.array(n_best[place]), "count_sum": pa.array(total[place])}
    return pa.table({f.name: out[f.name] for f in arrow_schema(RESULT)})


def align_documents(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """Of every row of docs: doc_id, its tokens, groups and links, n_best, count_sum and the digest of its groups."""
    index = pair_index(docs, paths)
    counts = written(pair_counts(index).select("a", "b", F.col("n_docs").alias("count"), "is_best"), "alignment-counts")
    parts = index.filter("a is not null").select("a", "b", F.col("block").alias("of_block"), "n_docs", "docs", "planes").join(counts.hint("merge"), ["a", "b"]).drop("a", "b")
    rows = index.filter("a is null").select("block", "place", *STATS, "groups_sha256")
    return rows.groupBy("block").cogroup(parts.groupBy("of_block")).applyInArrow(returned, RESULT)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))
