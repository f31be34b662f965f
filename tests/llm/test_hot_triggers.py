"""Repeats where one trigger has many entries, and where many rows have the same id and text."""

import random
from collections import Counter

import pyspark.sql.functions as F
import pytest

from boardlake.llm import repeats

SCHEMA = "doc_id long, text string"


def removed(spark, rows):
    packed, starts = repeats.repeated_starts(spark.createDataFrame(rows, SCHEMA).repartition(3))
    out = packed.join(starts, ["_k", "_h"], "left").select("doc_id", "z", "starts").mapInArrow(repeats.finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return sorted((r.doc_id, r.n_removed) for r in out.collect())


def brute(rows):
    seen = Counter(t[k : k + 200] for _, t in rows for k in range(len(t) - 199))
    return sorted((i, len({k + j for k in range(len(t) - 199) if seen[t[k : k + 200]] > 1 for j in range(200)})) for i, t in rows)


@pytest.mark.parametrize("bound", [0, 20])
def test_hot_trigger(spark, monkeypatch, bound):
    r = random.Random(8)
    noise = lambda n: "".join(r.choice("abcdefghijklmnop ") for _ in range(n))
    phrase, tail = noise(150), noise(90)
    rows = [(i, noise(300) + phrase + (tail if i % 7 == 0 else "") + noise(300)) for i in range(60)]
    rows += [(100, rows[3][1][50:420] + noise(100)), (101, rows[5][1])]
    monkeypatch.setattr(repeats, "HOT_ENTRIES", bound)
    got = removed(spark, rows)
    assert got == brute(rows)
    assert sum(n > 0 for _, n in got) > 9


def test_many_rows_of_one_id_and_text(spark):
    text = "".join(random.Random(9).choices("abcdefgh ", k=900))
    _, starts = repeats.repeated_starts(spark.createDataFrame([(None, text)] * 200, SCHEMA).repartition(8))
    row = starts.select(F.size("starts").alias("n"), F.size(F.array_distinct("starts")).alias("distinct")).collect()
    assert len(row) == 1 and row[0].n == row[0].distinct < 100
