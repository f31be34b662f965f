"""BPE encoding and decoding by speculation: propose, verify, and merge only what fails.

A text is split into words as the vocabulary file says (NFC, lower case, its pattern), and each distinct word is encoded
once. For the words of a batch that are new, greedy longest match proposes tokens. A proposal is the BPE result if and
only if each token encodes to itself and each adjacent pair encodes to that pair; the pairs of all proposals are tested
at once against sorted arrays of the verdicts so far, and pairs not seen yet get theirs by merging just these two
tokens. Only the words with a failing pair are merged exactly, lowest rank first and leftmost of equal ranks.

Caches hold up to `CACHE` words and are then emptied, so memory is bounded; results never depend on them. Decoding joins
the tokens' strings by blanks, as the library does for a vocabulary file without decoder.

Defined results: a null or empty text, or one of white space only, has no ids and decodes to the empty string. The
strings of special tokens in a text are their ids. Every row is encoded by itself: repeated rows, null ids and other
columns don't matter, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

CACHE = 300_000
STEP = 200
END = "</w>"
#: Code points outside the blocks whose letters are the same in every Unicode version since 6.0.
RARE = re.compile("[^\x00-\u0527\u1e00-\u1fff\u2000-\u206f\u20a0-\u20b5\u2100-\u214f\u3041-\u3096\u30a1-\u30fe\u4e00-\u9fa5\uac00-\ud7a3]")
SHIFT = 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next free code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Encoder for a vocabulary file of word BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.names: dict[int, str] = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names |= {i: t for t, i in self.special.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        v = self.vocab
        self.merges = {(v[a], v[b]): (rank, v[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.parts = {v[a + b]: (v[a], v[b]) for a, b in reversed(pairs)}
        self.letters = dict(enumerate(byte_letters()))
        self.longest = max(map(len, v))
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
        self.path, self.library = path, None
        self.known, self.good = np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids: dict[str, str] = {}
        self.count: dict[str, int] = {}
        self.shown: dict[str, str] = {}

    def symbols(self, word: str) -> list[str]:
        out = [self.letters[b] for b in word.encode("utf-8", "replace")]
        out[-1] += END
        return out

    def merge(self, ids: list[int]) -> list[int]:
        """Exact merging of symbol ids."""
        n = len(ids)
        ids, after, before = list(ids), [*range(1, n), -1], list(range(-1, n - 1))
        heap = [(*self.merges[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merges]
        heap = [(rank, i, new) for rank, new, i in heap]
        heapq.heapify(heap)
        while heap:
            rank, i, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or self.merges.get((ids[i], ids[j])) != (rank, new):
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (m := self.merges.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (m[0], a, m[1]))
        return [x for x in ids if x >= 0]

    def leaves(self, token: int) -> list[int]:
        out, todo = [], [token]
        while todo:
            t = todo.pop()
            if t in self.parts:
                a, b = self.parts[t]
                todo += [b, a]
            else:
                out.append(t)
        return out

    def propose(self, symbols: list[str]) -> list[int]:
        """Greedy longest match."""
        vocab, text, out, p, n = self.vocab, "".join(symbols), [], 0, len(symbols)
        while p < n:
            for q in range(min(n, p + self.longest), p, -1):
                t = vocab.get(text[p:q] if q < n else text[p:])
                if t is not None:
                    break
            out.append(t)
            p = q
        return out

    def verdicts(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key, a pair of tokens or a token with itself as -1, encodes to itself."""
        uniq, back = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.known, uniq)
        new = np.ones(len(uniq), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != uniq[inside]
        if new.any():
            fresh, mask = uniq[new], (1 << SHIFT) - 1
            good = np.zeros(len(fresh), bool)
            for i, k in enumerate(fresh.tolist()):
                own = [k >> SHIFT, k & mask] if k & mask != mask else [k >> SHIFT]
                good[i] = self.merge([x for t in own for x in self.leaves(t)]) == own
            known, verdict = np.concatenate([self.known, fresh]), np.concatenate([self.good, good])
            order = np.argsort(known)
            self.known, self.good = known[order], verdict[order]
            at = np.searchsorted(self.known, uniq)
        return self.good[at][back]

    def learn(self, words: list[str]) -> None:
        """Encodes words that the cache lacks."""
        if len(self.ids) + len(words) > CACHE:
            self.ids.clear(), self.count.clear(), self.shown.clear()
        if len(self.known) > 4 * CACHE:
            self.known, self.good = self.known[:0], self.good[:0]
        symbols = [self.symbols(w) for w in words]
        proposed = [self.propose(s) for s in symbols]
        flat = np.fromiter(chain.from_iterable(proposed), np.int64)
        size = np.fromiter(map(len, proposed), np.int64, len(proposed))
        first = np.cumsum(size) - size
        follows = np.full(len(flat), (1 << SHIFT) - 1, np.int64)
        follows[:-1] = flat[1:]
        follows[first + size - 1] = (1 << SHIFT) - 1
        ok = self.verdicts(flat << SHIFT | follows) & self.verdicts(flat << SHIFT | ((1 << SHIFT) - 1))
        for w, s, p, fine in zip(words, symbols, proposed, np.logical_and.reduceat(ok, first).tolist(), strict=True):
            ids = p if fine else self.merge([self.vocab[x] for x in s])
            self.ids[w], self.count[w] = " ".join(map(str, ids)), len(ids)
            self.shown[w] = " ".join([self.names[i] for i in ids])

    def split(self, text: str) -> list[str]:
        """The words of a text; special tokens stand for themselves."""
        if "<|" in text:
            out = []
            for part in self.specials.split(text):
                out += [part] if part in self.special else self.split_plain(part)
            return out
        return self.split_plain(text)

    def split_plain(self, text: str) -> list[str]:
        if not text.isascii():
            if RARE.search(text):
                return self.split_rare(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.words.findall(text.lower())

    def split_rare(self, text: str) -> list[str]:
        """By the library's own splitter, whose Unicode tables differ from Python's in letters added of late."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        flat = self.library.normalizer.normalize_str(text)
        return [flat[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(flat)]

    def encode(self, texts: list[str | None]) -> Iterator[list[str]]:
        """The words of each text, all of them in the caches while the text is at hand."""
        for lo in range(0, len(texts), STEP):
            rows = [self.split(t) if t else [] for t in texts[lo : lo + STEP]]
            new = set().union(*rows) - self.ids.keys()
            for s in new & self.special.keys():
                self.ids[s], self.count[s], self.shown[s] = str(self.special[s]), 1, s
                new.discard(s)
            if new:
                gone = len(self.ids) + len(new) > CACHE
                self.learn(list(set().union(*rows) - self.special.keys()) if gone else list(new))
                if gone:
                    for s, i in self.special.items():
                        self.ids[s], self.count[s], self.shown[s] = str(i), 1, s
            yield from rows

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.names[i] for i in ids])


_LOADED: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """One encoder for each worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def vocabulary() -> str:
    """The place of the default vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digest_rows(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            counts, ids, shown = [], [], []
            for words in bpe.encode(batch.column("text").to_pylist()):
                counts.append(sum(map(bpe.count.__getitem__, words)))
                ids.append(hashlib.sha256(" ".join(map(bpe.ids.__getitem__, words)).encode()).hexdigest())
                shown.append(hashlib.sha256(" ".join(map(bpe.shown.__getitem__, words)).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(shown, pa.string())], schema=schema)

    return run


def encode_column(text: Column, path: str | None = None) -> Column:
    """The token ids of a text column, array<int>."""
    path = path or vocabulary()

    def ids(batches):
        import pandas as pd

        bpe = encoder(path)
        for texts in batches:
            yield pd.Series([np.fromstring(" ".join(map(bpe.ids.__getitem__, w)), np.int32, sep=" ") if w else np.zeros(0, np.int32) for w in bpe.encode(texts.tolist())])

    from collections.abc import Iterator as It

    import pandas as pd

    ids.__annotations__ = {"batches": It[pd.Series], "return": It[pd.Series]}
    return F.pandas_udf(ids, "array<int>")(text)


def decode_column(ids: Column, path: str | None = None) -> Column:
    """The text of a column of token ids; null for null."""
    path = path or vocabulary()

    def text(batches):
        import pandas as pd

        bpe = encoder(path)
        for rows in batches:
            yield pd.Series([None if r is None else bpe.decode(r.tolist()) for r in rows])

    from collections.abc import Iterator as It

    import pandas as pd

    text.__annotations__ = {"batches": It[pd.Series], "return": It[pd.Series]}
    return F.pandas_udf(text, "string")(ids)


def encode_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text, for every row; no shuffle."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(digest_rows(path or vocabulary()), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))
