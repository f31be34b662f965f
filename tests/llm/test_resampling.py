"""Resampling against a plain version, with ties, nulls, long words, empty tables and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from boardlake.llm import resampling

SCHEMA = "doc_id long, text string, rank long, weight string"
rng = random.Random(3)
WORDS = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]


def grams(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return len(words), [zlib.crc32(b" ".join(words[i : i + k])) % resampling.BUCKETS for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain(docs, target, percent, least):
    s, t = Counter(), Counter()
    for d in docs:
        s.update(grams(d[1])[1])
    for text in target:
        t.update(grams(text)[1])
    n_s, n_t, out = sum(s.values()), sum(t.values()), []
    for doc_id, text, *_ in docs:
        n, found = grams(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1.0) * (n_s + 10000.0) / ((s[b] + 1.0) * (n_t + 10000.0)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, None])
    pool = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], math.inf if r[0] is None else r[0], r[1]))
    for k, r in enumerate(pool[: percent * len(pool) // 100]):
        r[5] = k + 1
    return sorted(map(str, ([*r[:4], r[5]] for r in out)))


def table(rows):
    return [(d, t, 7, "x") for d, t in rows]


@pytest.mark.parametrize("percent", [0, 5, 30, 100])
def test_equals_a_plain_version(spark, percent):
    rows = [(k, " ".join(rng.choice(WORDS) + rng.choice(["", "", "!", "\x00", "　"]) for _ in range(rng.randint(0, 40)))) for k in range(300)]
    rows += rows[5:9] * 3 + [(7, rows[11][1])] + [(None, None), (None, ""), (None, rows[3][1]), (None, rows[3][1]), (-5, "x" * 70000 + " tail"), (9, "ABC abc É é 1a_b")]
    target = [" ".join(rng.choice(WORDS[:20]) for _ in range(30)) for _ in range(9)] + [None, ""]
    docs = spark.createDataFrame(table(rows), SCHEMA).repartition(3)
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, 12)
    assert sorted(str(list(r)) for r in got.collect()) == plain(table(rows), target, percent, 12)


def test_equal_scores_go_to_smaller_ids(spark):
    docs = spark.createDataFrame([(k // 40, "same words here", 0, "") for k in range(400)] + [(2, "same words here and", 0, "")], SCHEMA)
    rows = [tuple(r) for r in docs.collect()]
    for percent in (7, 33, 50):
        got = resampling.resample(docs, docs.select("text"), percent, 1)
        assert sorted(str(list(r)) for r in got.collect()) == plain(rows, [r[1] for r in rows], percent, 1)


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b c", 0, "")], SCHEMA)
    assert resampling.resample(none, one).count() == 0
    assert [r["rank"] for r in resampling.resample(one, none, 100, 1).collect()] == [1]


def test_small_cache_and_steps_change_nothing(monkeypatch):
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 50))).encode() for _ in range(40)] + [b"", None]
    whole = [sorted(grams((t or b"").decode())[1]) for t in texts]
    monkeypatch.setattr(resampling, "CACHE", 10)
    monkeypatch.setattr(resampling, "STEP", 30)
    got = [[] for _ in texts]
    for lo, _, owner, found in resampling.Features().buckets(texts):
        for o, b in zip(owner.tolist(), found.tolist(), strict=True):
            got[lo + o].append(b)
    assert [sorted(g) for g in got] == whole
