"""Deleted interpolation against a plain version: counts, weights by expectation-maximisation, scores."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boardlake.llm import interpolation

rng = random.Random(4)
SCHEMA = "doc_id long, text string, role string, block int"
WORDS = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(80)]


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def prose(n):
    out, at = [], 0
    for _ in range(n):
        at = (at * 7 + rng.choice([1, 1, 1, 5, 30])) % len(WORDS)
        out.append(WORDS[at] if rng.random() < 0.95 else str(rng.randint(0, 10**6)))
    return " ".join(out)


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def counts(rows):
    uni, bi = Counter(), Counter()
    for t in rows:
        uni.update(t)
        bi.update(zip([None, *t[:-1]], t, strict=True))
    return uni, bi


def plain(docs):
    """docs: (doc_id, text, deleted)"""
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _, _ in docs]
    texts = [tokens(t) for _, t, _ in docs]
    uni, bi = counts([t for t, h in zip(texts, held, strict=True) if not h])
    r_uni, r_bi = counts([t for t, h, d in zip(texts, held, docs, strict=True) if not h and not d[2]])
    n, v, r_n = sum(uni.values()), len(uni), sum(r_uni.values())
    bucket = lambda c: c.bit_length()
    events = [(bucket(r_uni[a]), r_bi[a, b] / r_uni[a] if r_uni[a] else 0.0, r_uni[b] / max(r_n, 1), 1 / (v + 1)) for t, h, d in zip(texts, held, docs, strict=True) if not h and d[2] for a, b in zip([None, *t[:-1]], t, strict=True)]
    weights = {k: [1 / 3] * 3 if k else [0, 0.5, 0.5] for k in range(64)}
    before = None
    while events:
        e, like = {}, 0.0
        for b, *f in events:
            m = [x * y for x, y in zip(weights[b], f, strict=True)]
            own = e.setdefault(b, [1.0 * (x > 0) for x in weights[b]])
            like += math.log(sum(m))
            for k in range(3):
                own[k] += m[k] / sum(m)
        weights |= {b: [x / sum(own) for x in own] for b, own in e.items()}
        if before is not None and like - before <= interpolation.SETTLED * len(events):
            break
        before = like
    out = []
    for (doc_id, _, _), t, h in zip(docs, texts, held, strict=True):
        score = base = 0.0
        for a, b in zip([None, *t[:-1]], t, strict=True):
            x = weights[bucket(uni[a])]
            score += math.log10(x[0] * bi[a, b] / max(uni[a], 1) + x[1] * uni[b] / n + x[2] / (v + 1) if n else 1 / (v + 1))
            base += math.log10((uni[b] + 1) / (n + v + 1))
        out.append((doc_id, h, len(t), sum(uni[b] > 0 for b in t), n, base, score))
    return out


def same(got, want):
    shown = lambda rows: sorted(str((*r[:5], f"{r[5]:.6f}", f"{r[6]:.6f}")) for r in rows)
    assert shown(got) == shown(want)


@pytest.mark.parametrize("small", [False, True])
def test_equals_a_plain_version(spark, monkeypatch, small):
    if small:  # many blocks and ranges
        monkeypatch.setattr(interpolation, "BLOCK_TOKENS", 300)
        monkeypatch.setattr(interpolation, "GROUP_KEYS", 100)
    rows = [(k, prose(rng.randint(0, 60))) for k in range(250)]
    rows += rows[:6] * 4 + [(None, None), (3, ""), (4, " \n\t"), (5, "ÀB c\x1cd\xa0e"), (None, "same same same"), (16, "unseen-word"), (8, "w " * 3000)]
    docs = spark.createDataFrame([(d, t, "r", 3) for d, t in rows], SCHEMA).repartition(3)
    deleted = [(r[0], r[1], r[2]) for r in docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(interpolation.PARTS)) == 0).collect()]
    got = [tuple(r) for r in interpolation.score_documents(docs, held_out()).collect()]
    same(got, plain(deleted))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held) + len(held)


def test_nothing_to_learn_from_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "", 0), (2, None, "", 0)], SCHEMA)
    assert [tuple(r)[2:] for r in interpolation.score_documents(docs, F.lit(True)).orderBy("doc_id").collect()] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    assert interpolation.score_documents(docs.limit(0), held_out()).count() == 0


def test_packed_numbers():
    for values in ([], [0, 0, 0], [1, 300, 2**64 - 1, 5], list(range(1000))):
        x = np.array(values, np.uint64)
        assert (interpolation.unpack(interpolation.pack(x)) == x).all()


def test_a_block_is_scored_in_parts_and_read_alone():
    r = np.random.default_rng(3)
    lengths = r.integers(1, 900, 1500)
    m = int(lengths.sum())
    tokens = r.integers(0, 3000, m).astype(np.uint64)
    n_pairs = len(interpolation.Pairs(tokens, lengths.astype(np.uint64)).pairs)
    packed = {"lengths": lengths, "roles": r.integers(0, 3, len(lengths)), "tokens": tokens, "word_total": r.integers(0, 99, 3000), "pair_total": r.integers(0, 9, n_pairs)}
    row = {"doc_ids": list(range(len(lengths)))} | {k: interpolation.pack(v) for k, v in packed.items()}
    weights = np.full((interpolation.BUCKETS, 3), 1 / 3)
    score = lambda: pa.Table.from_batches(list(interpolation.scores_of(row, weights, 10**6, 10**5)))
    parts, out = list(interpolation.scores_of(row, weights, 10**6, 10**5)), score()
    assert len(parts) >= m // interpolation.PART_TOKENS and out.column("doc_id").to_pylist() == row["doc_ids"] and out.column("n_tokens").to_pylist() == lengths.tolist()
    whole, interpolation.PART_TOKENS = interpolation.PART_TOKENS, 1 << 40
    try:
        assert score().equals(out.combine_chunks())
    finally:
        interpolation.PART_TOKENS = whole
    batch = pa.RecordBatch.from_pydict({k: [v] * 3 for k, v in row.items()})
    assert list(interpolation.rows_of(iter([batch]))) == [row] * 3
