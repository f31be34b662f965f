"""Importance resampling towards a target distribution: array-scored weights, then bisection of the score for the cutoff.

Words are the runs of ASCII digits, a-z and whatever is not ASCII, after A-Z are lower-cased; features are all runs of one
to `RUN` words, joined by one blank, and hashed into `BUCKETS` buckets by their CRC-32. Documents and target texts are
counted by bucket, each task adding up an array of its own, and a bucket's gain says how much likelier it is in the target.
A second pass adds up the gains of each document's features and a Gumbel number from its id, so that the highest scores are
a draw without replacement by weight.

The draw needs a cutoff, not a sort of all documents: scores are written once, and jobs count exactly how many of them lie at
or above given scores; each job halves what is left `HALVINGS` times. Rows that tie with the cutoff are bisected in the same
way by doc_id, then by number of features, then by their place in the written table. Only the rows drawn are range-partitioned,
sorted within their partitions and numbered from the counts of the partitions before.

The checksum of a run of words is not taken from its bytes: that of a word is kept, and that of a concatenation is the first
one's advanced by the second's length, xor the second's, for whole arrays at once.

Defined results: null and empty texts have no features and weight 0; they still have a score and no rank. Rows with one id
share their Gumbel number; null ids have that of an empty id and come last among ties. Of equal rows as many are drawn as
fit. Other columns are not read. An empty target or table gives gains from the counts as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

BUCKETS = 10_000
RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Words in memory for each worker, words handled at once, halvings of an interval by one counting job.
CACHE, STEP, HALVINGS = 300_000, 1 << 20, 5
#: What each byte becomes: ASCII capitals their small letter, other ASCII but digits and small letters a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
POLYNOMIAL = 0xEDB88320
LAST = (1 << 63) - 1


def advance_tables() -> list[np.ndarray]:
    """For each k the effect on a checksum of 2**k zero bytes after it: an array (4, 256) by place and value of its bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1).astype(np.uint32)
    single = np.arange(256, dtype=np.uint32)[None] << (np.arange(4, dtype=np.uint32)[:, None] * 8)
    tables = [(single >> 8) ^ step[single & 255]]
    for _ in range(31):
        tables.append(through(tables[-1], tables[-1]))
    return tables


def through(tab: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tab[0][crc & 255] ^ tab[1][crc >> 8 & 255] ^ tab[2][crc >> 16 & 255] ^ tab[3][crc >> 24]


class Features:
    """Buckets of the features of texts; a bounded cache of words, on which no result depends."""

    def __init__(self):
        self.tables = advance_tables()
        self.forget()

    def forget(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.crc = self.after_blank = np.zeros(0, np.uint32)
        self.size = np.zeros(0, np.int64)

    def learn(self, words: list[bytes]) -> None:
        self.ids.update(zip(words, range(len(self.ids), len(self.ids) + len(words)), strict=True))
        sums = lambda it: np.fromiter(it, np.uint32, len(words))
        self.crc = np.concatenate([self.crc, sums(map(zlib.crc32, words))])
        self.after_blank = np.concatenate([self.after_blank, sums(zlib.crc32(b" " + w) for w in words)])
        self.size = np.concatenate([self.size, np.fromiter(map(len, words), np.int64, len(words))])

    def appended(self, crc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The checksums of texts with these checksums, a blank and these words after them."""
        crc, size = crc.copy(), self.size[word] + 1
        for k in range(int(size.max(initial=0)).bit_length()):
            some = np.flatnonzero(size >> k & 1)
            crc[some] = through(self.tables[k], crc[some])
        return crc ^ self.after_blank[word]

    def buckets(self, texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first text, words in each text from there, text, bucket): features of runs of texts, some STEP words at a time."""
        lo, words, n = 0, [], []
        for k, text in enumerate(texts):
            own = text.translate(LETTERS).split() if text else []
            words += own
            n.append(len(own))
            if len(words) >= STEP or k + 1 == len(texts):
                yield lo, np.array(n, np.int64), *self._hashed(words, np.array(n, np.int64))
                lo, words, n = k + 1, [], []

    def _hashed(self, words: list[bytes], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = set(words) - self.ids.keys()
        if len(self.ids) + len(new) > CACHE:
            self.forget()
            new = set(words)
        self.learn(list(new))
        word = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(n)), n)
        crc, owners, found = self.crc[word], [owner], [self.crc[word]]
        for k in range(1, RUN):
            inside = np.flatnonzero(owner[k:] == owner[: max(len(owner) - k, 0)])
            crc = crc[: max(len(owner) - k, 0)].copy()
            crc[inside] = self.appended(crc[inside], word[inside + k])
            owners.append(owner[inside])
            found.append(crc[inside])
        return np.concatenate(owners), np.concatenate(found) % np.uint32(BUCKETS)


_FEATURES: list[Features] = []


def features() -> Features:
    """One for each worker process."""
    if not _FEATURES:
        _FEATURES.append(Features())
    return _FEATURES[0]


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n): how many features of all rows fall into each bucket; a task sends one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, _, found in features().buckets(batch.column(0).to_pylist()):
                total += np.bincount(found, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    return texts.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket; BUCKETS numbers, whatever the input."""
    counts = np.zeros((2, BUCKETS), np.int64)
    for side, texts in enumerate((docs, target)):
        for r in bucket_counts(texts).collect():
            counts[side, r["bucket"]] = r["n"]
    all_docs, all_target = map(float, counts.sum(1).tolist())
    gain = lambda s, t: floor(1000 * log((t + 1) * (all_docs + BUCKETS) / ((s + 1) * (all_target + BUCKETS))))
    return np.array([gain(float(s), float(t)) for s, t in zip(*counts.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n, owner, found in features().buckets(batch.column("text").to_pylist()):
                weight = np.bincount(owner, gains[found], len(n)).astype(np.int64)
                many = sum(np.maximum(n - k, 0) for k in range(RUN))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, len(n)), pa.array(n), pa.array(many), pa.array(weight)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """A thousand times a Gumbel number that depends on the id and the seed alone, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def last_at_least(rows: DataFrame, value: str, most: int) -> tuple[int, int]:
    """(c, above): the least c such that at most `most` rows have a greater value, and how many have one.

    rows must have a row, more than `most` of them; each job counts all rows against some points at once.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    above = 0  # rows greater than high
    while low < high:
        points = sorted({low + (high - low) * k // (1 << HALVINGS) for k in range(1 << HALVINGS)})
        counts = rows.agg(*[F.count_if(F.col(value) > p) for p in points]).first()
        k = next((k for k, n in enumerate(counts) if n <= most), len(points))
        if k < len(points):
            high, above = points[k], counts[k]
        if k:
            low = points[k - 1] + 1
    return low, above


def drawn(rows: DataFrame, n: int) -> Column:
    """The condition that exactly n of rows fit: the highest scores, ties to the smaller id, then fewer features, then place."""
    chosen, tied = F.lit(False), F.lit(True)
    for value in ("_score", "_id", "_features", "_row"):
        if n <= 0:
            return chosen
        some = rows.filter(tied)
        if value == "_score" and n >= some.count():
            return tied
        cut, above = last_at_least(some, value, n)
        chosen, tied, n = chosen | (tied & (F.col(value) > cut)), tied & (F.col(value) == cut), n - above
    return chosen | tied if n else chosen


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with rank 1, 2, 3, ... in this order: ranges of it are sorted by themselves, and follow the counts of those before."""
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "resampling-ranges")
    part = F.shiftright("_at", 33)
    first, before = [], 0
    for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect():  # one row for each partition of the shuffle
        first.append((r["part"], before))
        before += r["n"]
    starts = placed.sparkSession.createDataFrame(first, "_part long, _before long")
    return placed.withColumn("_part", part.cast("long")).join(F.broadcast(starts), "_part").withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_before", "_at")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null: not drawn) of every row of docs.

    percent of the rows with at least least_words words are drawn, rounded down.
    """
    scored = weigh(docs, bucket_gains(docs, target)).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    # what is bisected grows downwards from the first choice, so ids and counts are negated
    keys = {"_score": F.col("score"), "_id": F.bitwise_not(F.coalesce("doc_id", F.lit(LAST))), "_features": -F.col("n_features"), "_row": -F.monotonically_increasing_id()}
    scored = written(scored.withColumns(keys), "resampling-scores")
    pool = F.col("n_words") >= least_words
    rows = scored.filter(pool)
    chosen = pool & drawn(rows, percent * rows.count() // 100)
    columns = ["doc_id", "n_features", "weight", "score"]
    ranks = ranked(scored.filter(chosen), [F.col(k).desc() for k in keys])
    return ranks.select(*columns, "rank").unionByName(scored.filter(~chosen).select(*columns, F.lit(None).cast("long").alias("rank")))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_RUNS = " union all ".join(f"select id, array_to_string(w[i:i+{k}], ' ') as f from (select id, w, unnest(range(1, len(w) - {k - 1})) as i from {{0}} where len(w) > {k})" for k in range(RUN))
ORACLE = f"""
with crc_table as materialized (select list(list_reduce(range(8), lambda x, _: xor(x >> 1, {POLYNOMIAL} * (x & 1)), v) order by v) as t from range(256) r(v)),
d as materialized (select row_number() over () as id, doc_id, {_WORDS} as w from documents),
b as (select row_number() over () as id, {_WORDS} as w from benchmark),
df as materialized ({_RUNS.format('d')}), bf as materialized ({_RUNS.format('b')}),
every as (select distinct f from df union select distinct f from bf),
coded as (select f, hex(encode(f)) as x from every),
hashed as materialized (select f, xor(list_reduce(list_transform(range(len(x) // 2), lambda i: ('0x' || x[2*i+1:2*i+2])::bigint), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % {BUCKETS} as bucket from coded, crc_table),
s as (select bucket, count(*) as n from df join hashed using (f) group by bucket), t as (select bucket, count(*) as n from bf join hashed using (f) group by bucket),
totals as (select coalesce((select sum(n) from s), 0)::double as ss, coalesce((select sum(n) from t), 0)::double as tt),
gains as (select bucket, floor(1000 * ln((coalesce(t.n, 0) + 1.0::double) * (ss + {BUCKETS}) / ((s.n + 1.0::double) * (tt + {BUCKETS}))))::bigint as gain from s left join t using (bucket), totals),
weights as (select id, count(*) as n_features, sum(gain)::bigint as weight from df join hashed using (f) join gains using (bucket) group by id),
scored as (select id, doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || coalesce(doc_id::varchar, ''))[1:8])::bigint + 0.5::double) / 4294967296)))::bigint as score from d left join weights using (id)),
placed as (select id, row_number() over (order by score desc, doc_id nulls last, n_features) as place from scored where n_words >= {LEAST_WORDS})
select doc_id, n_features, weight, score, case when place <= {PERCENT} * (select count(*) from placed) // 100 then place end as rank from scored left join placed using (id)
"""
