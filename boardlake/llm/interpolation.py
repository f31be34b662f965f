"""Language-model scores by deleted interpolation of n-grams.

The probability of a token w after v is a mixture: its share among the tokens after v, its share among all tokens, and an even
share for each known token and one unknown. What each part weighs depends on how often v was seen, by powers of two. The
weights come from expectation-maximisation over counts held out: training documents are split by a hash of their id, one of
`PARTS` parts is deleted, and the weights are those that make its tokens likeliest under the counts of the rest. Scores then
use the counts of all training documents.

Tokens are words with A-Z lower-cased, then one end, which is also what the first token follows. Longer n-grams are left out:
four of five triples of tokens in a large corpus are new, and each would cost its way over the network twice.

Documents are read once, into blocks of some `BLOCK_TOKENS` tokens: the hashes of their words and a number for each token. A
block asks for each of its words and pairs once, whatever their frequency; requests are dealt by ranges of the hash, so that
a group holds some `GROUP_KEYS` keys, and each group answers with the counts of the whole corpus, in the order asked, so no
key travels back. Blocks with their answers are written, and from there both the fit and the scores are maps without a
shuffle. Only sums by weight bucket, and numbers of tokens and words, go to the driver. Keys are 64-bit hashes.

Defined results: a null or empty text is its end alone. Null ids are not held out and are learnt from. Repeated rows are
rows of their own and count each. Without training rows every token has the even share, 1 (the base: log10 of 1). Without deleted rows
the parts weigh the same. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, table, written

PARTS = 8
BLOCK_TOKENS, GROUP_KEYS, PART_TOKENS = 3 << 19, 1 << 20, 1 << 17
#: Buckets of context frequencies: 0, and the powers of two up to 2**62.
BUCKETS = 64
#: What each part of each bucket is given before counting, and the gain in log-likelihood a token at which the weights are settled.
PRIOR, SETTLED = 1.0, 1e-5
TRAIN, DELETED, HELD_OUT = 0, 1, 2
BLOCK = "block long, doc_ids array<long>, lengths binary, roles binary, tokens binary, n_tokens long, n_words long, n_train long, words binary"
REQUEST = "kind int, bucket long, block long, keys binary, total binary, deleted binary"
ANSWER = "kind int, bucket long, block long, total binary, deleted binary, n_distinct long"
RESOLVED = "doc_ids array<long>, lengths binary, roles binary, tokens binary, word_total binary, word_deleted binary, pair_total binary, pair_deleted binary"
EVENT = "context long, pair long, word long, n long"
SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


SCHEMAS = {ddl: arrow_schema(ddl) for ddl in (BLOCK, REQUEST, ANSWER, RESOLVED, EVENT, SCORE)}


def batch_of(ddl: str, **columns) -> pa.RecordBatch:
    schema = SCHEMAS[ddl]
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def pack(values: np.ndarray) -> bytes:
    """Numbers without sign as planes of their bytes, compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return struct.pack("<QB", len(values), width) + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", data)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(data[9:], n * width, "zstd"), np.uint8).reshape(width, n).T if n else 0
    return out.view("<u8").reshape(-1)


def deltas(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted keys, the first as it is."""
    return np.diff(keys, prepend=np.zeros(1, np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX[1]
        x = (x ^ (x >> np.uint64(27))) * MIX[2]
        return x ^ (x >> np.uint64(31))


class Pairs:
    """The tokens of a block with what each follows, and its different pairs in the order of (context, word)."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray):
        self.word = tokens.astype(np.int64)
        self.ends = np.cumsum(lengths.astype(np.int64))
        self.context = np.roll(self.word, 1)
        if len(lengths):
            self.context[self.ends - lengths.astype(np.int64)] = 0
        self.pairs, self.pair = np.unique(self.context << 32 | self.word, return_inverse=True)

    def hashes(self, words: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(words[self.pairs >> 32] * MIX[0] + mixed(words[self.pairs & 0xFFFFFFFF] + MIX[0]))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of batches, one at a time: a row is a block, and a batch may hold 64 MiB of them."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def asked(hashes: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which hashes are asked for, and the bucket of each in that order."""
    order = np.argsort(hashes, kind="stable")
    return order, ((hashes[order] >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def blocks_of(docs: DataFrame) -> DataFrame:
    """Blocks of the rows of docs (doc_id, text, role); word 0 of a block is the end."""

    def flush(block: int, ids: dict[bytes, int], doc_ids: list, roles: list, lengths: list, tokens: list) -> pa.RecordBatch:
        lengths, roles = np.array(lengths, np.int64), np.array(roles, np.int64)
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids))
        train = int(lengths[roles != HELD_OUT].sum())
        return batch_of(BLOCK, block=[block], doc_ids=[doc_ids], lengths=[pack(lengths)], roles=[pack(roles)], tokens=[pack(np.concatenate(tokens))], n_tokens=[int(lengths.sum())], n_words=[len(ids)], n_train=[train], words=[pack(words)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, doc_ids, roles, lengths, tokens, size = TaskContext.get().partitionId() << 32, {b"": 0}, [], [], [], [], 0
        for batch in batches:
            texts, own = batch.column("text").to_pylist(), []
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("role").to_pylist(), texts, strict=True)
            for k, (doc_id, role, text) in enumerate(rows):
                words = text.lower().split() if text else []
                own += words
                own.append(b"")
                doc_ids.append(doc_id), roles.append(role), lengths.append(len(words) + 1)
                if len(own) >= BLOCK_TOKENS // 8 or k + 1 == len(texts):
                    new = set(own) - ids.keys()
                    ids.update(zip(new, range(len(ids), len(ids) + len(new)), strict=True))
                    tokens.append(np.fromiter(map(ids.__getitem__, own), np.uint32, len(own)))
                    size, own = size + len(own), []
                    if size >= BLOCK_TOKENS:
                        yield flush(block, ids, doc_ids, roles, lengths, tokens)
                        block, ids, doc_ids, roles, lengths, tokens, size = block + 1, {b"": 0}, [], [], [], [], 0
        if doc_ids:
            yield flush(block, ids, doc_ids, roles, lengths, tokens)

    return written(docs.mapInArrow(run, BLOCK), "interpolation-blocks")


def requests(blocks: DataFrame, n_buckets: tuple[int, int]) -> DataFrame:
    """For each block and range of hashes the words (kind 0) and pairs (kind 1) of the block with its own counts in training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            lengths, roles, words = unpack(row["lengths"]), unpack(row["roles"]), unpack(row["words"])
            pairs = Pairs(unpack(row["tokens"]), lengths)
            role = np.repeat(roles, lengths.astype(np.int64))
            for kind, hashes, of in ((0, words, pairs.word), (1, pairs.hashes(words), pairs.pair)):
                total, deleted = (np.bincount(of[some], minlength=len(hashes)) for some in (role != HELD_OUT, role == DELETED))
                order, bucket = asked(hashes, n_buckets[kind])
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
                for lo, hi in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
                    some = order[lo:hi]
                    yield batch_of(REQUEST, kind=[kind], bucket=[int(bucket[lo])], block=[row["block"]], keys=[pack(deltas(hashes[some]))], total=[pack(total[some])], deleted=[pack(deleted[some])])

    return blocks.select("block", "lengths", "roles", "tokens", "words").mapInArrow(run, REQUEST)


def answers_of(group: pa.Table) -> pa.Table:
    """The counts of the corpus for the keys that each block asks for, in its order."""
    keys = [np.cumsum(unpack(k), dtype=np.uint64) for k in group.column("keys").to_pylist()]
    ends = np.cumsum([len(k) for k in keys])
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    of = {}
    for name in ("total", "deleted"):
        counts = np.bincount(at, np.concatenate([unpack(c) for c in group.column(name).to_pylist()])).astype(np.int64)
        of[name] = [pack(c) for c in np.split(counts[at], ends[:-1])]
        if name == "total":
            n_distinct = np.zeros(len(keys), np.int64)
            n_distinct[0] = np.count_nonzero(counts)
    return pa.Table.from_batches([batch_of(ANSWER, kind=group.column("kind").to_pylist(), bucket=group.column("bucket").to_pylist(), block=group.column("block").to_pylist(), **of, n_distinct=n_distinct)])


def resolver(n_buckets: tuple[int, int]):
    def resolve(block: pa.Table, answers: pa.Table) -> pa.Table:
        row, found = block.to_pylist()[0], sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        words, own = unpack(row["words"]), {}
        for kind, name in enumerate(("word", "pair")):
            hashes = words if kind == 0 else Pairs(unpack(row["tokens"]), unpack(row["lengths"])).hashes(words)
            order, _ = asked(hashes, n_buckets[kind])
            for what in ("total", "deleted"):
                counts = np.zeros(len(hashes), np.uint64)
                counts[order] = np.concatenate([unpack(r[what]) for r in found if r["kind"] == kind])
                own[f"{name}_{what}"] = [pack(counts)]
        return pa.Table.from_batches([batch_of(RESOLVED, **{k: [row[k]] for k in ("doc_ids", "lengths", "roles", "tokens")}, **own)])

    return resolve


def resolved(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """The blocks with the counts of the corpus for their words and pairs; the training tokens and how many are different."""
    blocks = blocks_of(docs)
    n_tokens, n_words, n_train = (x or 0 for x in blocks.agg(F.sum("n_tokens"), F.sum("n_words"), F.sum("n_train")).first())
    n_buckets = tuple(n // GROUP_KEYS + 1 for n in (n_words, n_tokens))
    answers = written(requests(blocks, n_buckets).groupBy("kind", "bucket").applyInArrow(answers_of, ANSWER), "interpolation-answers")
    distinct = answers.filter("kind = 0").agg(F.sum("n_distinct")).first()[0] or 0
    asked_by = answers.select(F.col("block").alias("of_block"), "kind", "bucket", "total", "deleted")
    out = written(blocks.groupBy("block").cogroup(asked_by.groupBy("of_block")).applyInArrow(resolver(n_buckets), RESOLVED), "interpolation-resolved")
    discard(blocks, answers)
    return out, n_train, distinct


def held_out_events(blocks: DataFrame) -> DataFrame:
    """(context, pair, word, n): tokens of deleted documents by the counts, in the rest, of what they follow, of both together and of themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            lengths, roles = unpack(row["lengths"]), unpack(row["roles"])
            if not (roles == DELETED).any():
                continue
            pairs = Pairs(unpack(row["tokens"]), lengths)
            some = np.flatnonzero(np.repeat(roles, lengths.astype(np.int64)) == DELETED)
            word, pair = (unpack(row[f"{k}_total"]) - unpack(row[f"{k}_deleted"]) for k in ("word", "pair"))
            three = np.stack([word[pairs.context[some]], pair[pairs.pair[some]], word[pairs.word[some]]], 1)
            three, n = np.unique(np.ascontiguousarray(three).view([("c", "u8"), ("p", "u8"), ("w", "u8")]).reshape(-1), return_counts=True)
            yield batch_of(EVENT, context=three["c"].astype(np.int64), pair=three["p"].astype(np.int64), word=three["w"].astype(np.int64), n=n)

    rows = blocks.select("lengths", "roles", "tokens", "word_total", "word_deleted", "pair_total", "pair_deleted").mapInArrow(run, EVENT)
    return rows.groupBy("context", "pair", "word").agg(F.sum("n").alias("n"))


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else 1 + the whole part of the logarithm to base 2."""
    return np.where(count > 0, np.frexp(count.astype(np.float64))[1], 0)


def fit_weights(events: DataFrame, n_retained: int, n_distinct: int) -> np.ndarray:
    """(BUCKETS, 3): what the shares after the context, among all tokens and the even one weigh, by expectation-maximisation."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    bucket = F.when(F.col("context") > 0, F.floor(F.log2("context")).cast("int") + 1).otherwise(0)
    after = F.when(F.col("context") > 0, F.col("pair") / F.col("context")).otherwise(0.0)
    rows = written(events.select(bucket.alias("b"), after.alias("f0"), (F.col("word") / F.lit(max(n_retained, 1))).alias("f1"), F.lit(1 / (n_distinct + 1)).alias("f2"), "n"), "interpolation-events")
    before = None
    while True:
        parts = [F.get(F.array(*map(F.lit, weights[:, k].tolist())), F.col("b")) * F.col(f"f{k}") for k in range(3)]
        one = rows.select("b", "n", *[p.alias(f"m{k}") for k, p in enumerate(parts)], sum(parts, F.lit(0.0)).alias("p"))
        sums = one.groupBy("b").agg(*[F.sum(F.col("n") * F.col(f"m{k}") / F.col("p")).alias(f"e{k}") for k in range(3)], F.sum(F.col("n") * F.log("p")).alias("l"), F.sum("n").alias("n")).collect()
        n, likelihood = sum(r["n"] for r in sums), sum(r["l"] for r in sums)
        for r in sums:
            e = np.array([r[f"e{k}"] for k in range(3)]) + PRIOR * (weights[r["b"]] > 0)
            weights[r["b"]] = e / e.sum()
        if not n or (before is not None and likelihood - before <= SETTLED * n):
            discard(rows)
            return weights
        before = likelihood


def scores_of(row: dict, weights: np.ndarray, n_train: int, n_distinct: int) -> Iterator[pa.RecordBatch]:
    """The scores of a block's documents, some `PART_TOKENS` tokens at a time: what is made of a token has many times its bytes."""
    lengths, roles = unpack(row["lengths"]).astype(np.int64), unpack(row["roles"])
    pairs, word, pair = Pairs(unpack(row["tokens"]), lengths), unpack(row["word_total"]), unpack(row["pair_total"])
    even, lo = 1 / (n_distinct + 1), 0
    while lo < len(lengths):
        begin = pairs.ends[lo] - lengths[lo]
        hi = max(int(np.searchsorted(pairs.ends, begin + PART_TOKENS, "right")), lo + 1)
        docs, part = slice(lo, hi), slice(begin, pairs.ends[hi - 1])
        c, w, p = word[pairs.context[part]], word[pairs.word[part]], pair[pairs.pair[part]]
        own, starts = weights[bucket_of(c)], pairs.ends[docs] - lengths[docs] - begin
        prob = own[:, 0] * p / np.maximum(c, 1) + own[:, 1] * w / max(n_train, 1) + own[:, 2] * even if n_train else np.full(len(w), even)
        total = lambda x: np.add.reduceat(x, starts)  # noqa: B023, E731
        base = np.log10((w + 1.0) / (n_train + n_distinct + 1.0))
        yield batch_of(SCORE, doc_id=row["doc_ids"][docs], held_out=roles[docs] == HELD_OUT, n_tokens=lengths[docs], n_known=total((w > 0).astype(np.int64)), train_tokens=np.full(hi - lo, n_train), base_score=total(base), score=total(np.log10(prob)))
        lo = hi


def scores(blocks: DataFrame, weights: np.ndarray, n_train: int, n_distinct: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield from scores_of(row, weights, n_train, n_distinct)

    return blocks.select("doc_ids", "lengths", "roles", "tokens", "word_total", "pair_total").mapInArrow(run, SCORE)


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs. held_out: a condition on doc_id; such rows are not learnt from."""
    role = F.when(F.coalesce(held_out, F.lit(False)), HELD_OUT).when(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)) == 0, DELETED).otherwise(TRAIN)
    blocks, n_train, n_distinct = resolved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), role.alias("role")))
    events = written(held_out_events(blocks), "interpolation-counts")
    n_deleted = events.agg(F.sum("n")).first()[0] or 0
    weights = fit_weights(events, n_train - n_deleted, n_distinct)
    discard(events)
    return scores(blocks, weights, n_train, n_distinct)


def op11_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
