"""Alignment against a plain version that encodes whole texts with both libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from boardlake.llm import alignment
from boardlake.llm.bpe import byte_letters

rng = random.Random(8)
SCHEMA = "doc_id long, text string, block string, a int"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = alignment.vocabularies()
    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    return a, b


def spelled(a, b, a_ids, b_ids):
    byte_of = {c: k for k, c in enumerate(byte_letters())}
    a_text = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in a_ids]
    b_text = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    return a_text, b_text


def plain(rows, libraries):
    a, b = libraries
    docs, holds = [], defaultdict(set)
    for n, (doc_id, text) in enumerate(rows):
        groups, a_ids, b_ids = [], [], []
        if text:
            a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            a_text, b_text = spelled(a, b, a_ids, b_ids)
            if not b"".join(a_text) == b"".join(b_text) == (" " + text).encode():
                a_ids, b_ids = [], []
            i = j = x = y = 0
            own = ([], [])
            while i < len(a_ids) or j < len(b_ids):
                if x <= y and i < len(a_ids):
                    own[0].append(a_ids[i])
                    x += len(a_text[i])
                    i += 1
                else:
                    own[1].append(b_ids[j])
                    y += len(b_text[j])
                    j += 1
                if x == y and own[0] and own[1]:
                    groups.append(own)
                    own = ([], [])
        links = Counter((p, q) for g in groups for p in g[0] for q in g[1])
        for pair in links:
            holds[pair].add(n)
        docs.append((doc_id, len(a_ids), len(b_ids), groups, links))
    best = Counter()
    for (p, _), found in holds.items():
        best[p] = max(best[p], len(found))
    out = []
    for doc_id, n_a, n_b, groups, links in docs:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n_best = sum(m for pair, m in links.items() if len(holds[pair]) == best[pair[0]])
        total = sum(m * len(holds[pair]) for pair, m in links.items())
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), n_best, total, hashlib.sha256(shown.encode()).hexdigest() if groups else ""))
    return sorted(map(str, out))


PIECES = ["the ", "of", " ", "  ", "\n", "\n\n ", "\t", " \t x", "word", "'s ", "é", "é", "　", "\xa0", "42 ", "<|endoftext|>", "<s>", "</s>", "<0x41>", "日本", "😀", ";\r\n", "\r", "\x00", "\x1c", "\x85", "ing ", "#!", "...", "a" * 30, "▁", "ﬁ", " "]


def fixture_rows(n=220):
    rows = [(k, "".join(rng.choice(PIECES[: rng.choice([9, 30, len(PIECES)])]) for _ in range(rng.randint(1, 60)))) for k in range(n)]
    return rows + rows[:4] * 3 + [(None, None), (3, None), (4, ""), (None, " "), (5, "\n"), (6, "x "), (7, "long" * 9000), (8, "1 2 " * 9000), (9, "▁"), (9, "word " * 500)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_a_plain_version(spark, libraries, monkeypatch, small):
    if small:  # many blocks, a cache that is emptied over and over; closures carry these values to the workers
        monkeypatch.setattr(alignment, "BLOCK_DOCS", 16)
        monkeypatch.setattr(alignment, "STEP", 50)
    rows = fixture_rows()
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3)
    got = alignment.align_documents(docs)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows, libraries)


def test_units_are_encoded_alike_anywhere(libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CACHE", 40)
    tool, (a, b) = alignment.Aligner(*alignment.vocabularies()), libraries
    for _, text in fixture_rows(400):
        stats, _, _, _ = tool.align([text])
        if text and stats[0, 0]:
            assert stats[0, 0] == len(a.encode(" " + text, add_special_tokens=False).ids)
            assert stats[0, 1] == len(b.encode(text))


def test_pair_counts(spark):
    docs = spark.createDataFrame([(1, "the the word"), (2, "the word"), (2, "the"), (3, None)], "doc_id long, text string")
    rows = alignment.pair_counts(alignment.pair_index(docs)).collect()
    assert sorted((r["n_docs"], r["n_links"], r["is_best"]) for r in rows) == [(2, 2, True), (3, 4, True)]


def test_bitmaps_and_planes():
    import numpy as np

    for n in (1, 9, 300, 60000):
        places = np.array(sorted(rng.sample(range(65536), n)))
        times = np.array([rng.choice([1, 1, 2, 3, 700]) for _ in range(n)])
        assert (alignment.unpacked(alignment.packed(places)) == places).all()
        if times.max() > 1:
            assert (alignment.times_of(alignment.planes_of(times), n) == times).all()


def test_empty_table(spark):
    assert alignment.align_documents(spark.createDataFrame([], SCHEMA)).count() == 0
