"""Toxicity: subword-bag embeddings, averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its character n-grams (3 to 6, with marks for its start and end) and of itself, all
hashed; a text is the mean of its words, where a word counts SMOOTH / (SMOOTH + its frequency in training); a softmax layer gives the probability of label 1. Vectors and layer are trained
together by full-batch Adam. Because words share n-gram vectors, spellings never seen in training score like their kin.

Training takes labelled rows up to `CLASS_ROWS` of each class (the ones with the lowest hash of doc_id, so the choice is
the same on every run) and up to `TRAIN_BYTES` of whole texts, in the same order; the shares of the classes among all
labelled rows then set the bias. The two bounds limit what is fitted on, and so what the driver holds; all words of the texts
are fitted on, and every word of every text is scored. Scoring covers every row with
whole texts, from a table of one number for each n-gram bucket (`2 ** BITS` numbers, whatever the input).

Defined results: a null or empty text has the score of the bias alone. Labels other than 0 and 1, labels of unknown
documents, null ids and ids with both labels are not learnt from; of several texts with one id the shortest is (the least
of equal length). If a class has no labelled row, every score is that of an even bias. Repeated
rows each get their score; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

BITS = 18
DIM = 4
SIZES = (3, 4, 5, 6)
CLASS_ROWS = 3000
TRAIN_BYTES = 12 << 20
#: Settings of the training: scale of the layer's input, share of the largest step size that evens out the others, decay, and the frequency at which a word's weight is halved.
GAIN, FLAT, DECAY, SMOOTH = 200.0, 1e-3, 2e-4, 3e-3
CACHE = 400_000
STRIP = ".,;:!?\"'()[]{}<>|#*$%&~`_-+=/\\"


def words_in(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) for each n-gram of each word and for the word itself, over the code points of all words at once."""
    marked = ["\x02" + (w.strip(STRIP) or w) + "\x03" for w in words]
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), size)
    spread, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - BITS)
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(data), np.uint64)
        weight = np.concatenate([np.arange(s) for s in size]).astype(np.uint64) if len(size) else data
        rolled = (data + np.uint64(7)) * (weight * np.uint64(2) + np.uint64(1)) * spread
        whole = np.add.reduceat(rolled ^ (rolled >> np.uint64(29)), np.cumsum(size) - size) if len(size) else rolled
        owners, found = [np.arange(len(words))], [((whole * spread) >> shift).astype(np.int64)]
        for n in SIZES:
            m = len(data) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for i in range(n):
                h = (h * np.uint64(0x100000001B3)) ^ data[i : i + m]
            inside = owner[:m] == owner[n - 1 :]
            owners.append(owner[:m][inside])
            found.append(((h * spread) >> shift).astype(np.int64)[inside])
    return np.concatenate(owners), np.concatenate(found)


def train(texts: list[str], labels: list[int], epochs: int = 60, rate: float = 0.1, decay: float = DECAY, seed: int = 5) -> tuple[np.ndarray, float, dict[str, float]]:
    """A number for each bucket, the bias and the weights of frequent words; bias + the mean over words of weight times the mean over n-grams is the log-odds."""
    y = np.array(labels, np.float64)
    ids: dict[str, int] = {}
    docs, found, times, sizes = [], [], [], np.zeros(len(texts))
    for d, t in enumerate(texts):
        every = np.fromiter((ids.setdefault(w, len(ids)) for w in words_in(t)), np.int32)
        own, n = np.unique(every, return_counts=True)
        docs.append(np.full(len(own), d, np.int32)), found.append(own), times.append(n.astype(np.int32))
        sizes[d] = max(len(every), 1)
    doc, word, n = np.concatenate(docs), np.concatenate(found), np.concatenate(times)
    if not len(ids):
        return np.zeros(1 << BITS, np.float32), 0.0, {}
    often = np.bincount(word, n, len(ids))
    weight_of = SMOOTH / (SMOOTH + often / often.sum())
    share = n * weight_of[word] / sizes[doc]
    vocabulary = list(ids)
    frequent = {w: v for w, v in zip(vocabulary, weight_of.tolist(), strict=True) if v < 0.98}
    del ids, docs, found, times
    owner, bucket = (x.astype(np.int32) for x in buckets(vocabulary))
    part = (1 / np.bincount(owner, minlength=len(vocabulary)))[owner]
    used, bucket = np.unique(bucket, return_inverse=True)
    bucket = bucket.astype(np.int32)
    rng = np.random.default_rng(seed)
    e, w, b = np.zeros((len(used), DIM)), rng.normal(0, 1, (DIM, 2)), np.zeros(2)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (e, w, b)]
    # rows of either class count the same here; the bias gets the true shares afterwards
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    gather = lambda index, values, at, scale, n: np.stack([np.bincount(index, values[at, k] * scale, n) for k in range(DIM)], 1)
    for step in range(1, epochs + 1):
        words = gather(owner, e, bucket, part, len(vocabulary))
        mean = gather(doc, words, word, share, len(y))
        z = mean @ w * GAIN + b
        p = 1 / (1 + np.exp(z[:, 0] - z[:, 1]))
        d = np.stack([y - p, p - y], 1) * weight[:, None]
        dmean = d @ w.T * GAIN
        dwords = gather(word, dmean, doc, share, len(vocabulary))
        grads = (gather(bucket, dwords, owner, part, len(used)) + decay * e, mean.T @ d * GAIN, d.sum(0))
        for (m, v), g, at in zip(moments, grads, (e, w, b), strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            at -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + FLAT * np.sqrt(v.max() / (1 - 0.99**step)) + 1e-12)
    number = np.zeros(1 << BITS, np.float32)
    number[used] = e @ (w[:, 1] - w[:, 0]) * GAIN
    return number, float(b[1] - b[0]), frequent


def labelled_rows(docs: DataFrame, labels: DataFrame, learn_from) -> tuple[list, dict[int, int]]:
    """Up to CLASS_ROWS rows of each class and TRAIN_BYTES of text that learn_from admits, and how many of each class there are."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & learn_from).groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").cast("int").alias("_other"))
    known = known.filter(F.col("toxic") == F.col("_other")).select("doc_id", "toxic")
    shares = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [known.filter(F.col("toxic") == k).orderBy(*order).limit(CLASS_ROWS) for k in (0, 1)]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("size", F.octet_length("text"))
    sizes = texts.drop("text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").groupBy("doc_id", "toxic").agg(F.min("size").alias("size"))
    # a window over the sizes of the chosen rows, 2 * CLASS_ROWS at most; only texts that fit the bound are moved
    kept = sizes.withColumn("upto", F.sum("size").over(Window.orderBy(*order))).filter(F.col("upto") <= TRAIN_BYTES).drop("upto")
    rows = texts.join(F.broadcast(kept), ["doc_id", "size"]).groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return rows.orderBy("doc_id").select("doc_id", "toxic", "text").collect(), shares


def fit(docs: DataFrame, labels: DataFrame, learn_from) -> tuple[np.ndarray, float, dict[str, float]]:
    rows, shares = labelled_rows(docs, labels, learn_from)
    if len({r["toxic"] for r in rows}) < 2:
        return np.zeros(1 << BITS, np.float32), 0.0, {}
    number, bias, weights = train([r["text"] or "" for r in rows], [r["toxic"] for r in rows])
    return number, bias + log(shares[1] / shares[0]), weights


_SCORES: dict[str, float] = {}
_MODEL: list = [None]


def scorer(number: np.ndarray, bias: float, weights: dict[str, float]):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])
    mark = float(number.sum()), float(np.abs(number).sum()), bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _MODEL[0] != mark:
            _SCORES.clear()
            _MODEL[0] = mark
        for batch in batches:
            texts, out = batch.column("text").to_pylist(), []
            for lo in range(0, len(texts), 200):
                rows = [words_in(t) for t in texts[lo : lo + 200]]
                new = set().union(*rows) - _SCORES.keys()
                if len(_SCORES) + len(new) > CACHE:
                    _SCORES.clear()
                    new = set().union(*rows)
                if new:
                    words = list(new)
                    owner, bucket = buckets(words)
                    total = np.bincount(owner, number[bucket], len(words)) / np.bincount(owner, minlength=len(words))
                    total *= np.fromiter((weights.get(w, 1.0) for w in words), np.float64, len(words))
                    _SCORES.update(zip(words, total.tolist(), strict=True))
                out += [sum(map(_SCORES.__getitem__, r)) / len(r) if r else 0.0 for r in rows]
            z = np.clip(np.array(out, np.float64) + bias, -50, 50)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(1 / (1 + np.exp(-z)))], schema=schema)

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of docs. held_out: a condition on doc_id; such rows are not learnt from."""
    model = fit(docs, labels, ~F.coalesce(held_out, F.lit(False)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    out = rows.mapInArrow(scorer(*model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_toxicity(docs, labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
