"""URL verdicts: rules by host and path first, else a logistic regression over hashed character n-grams.

The model is trained here, in numpy, from a small table of labelled URLs that `labelled_urls` builds from word lists by
rule. Its features are the byte n-grams of 3 to 5 bytes of the host and of the path, hashed together with the part they
stand in; a URL's vector has length one. Scoring runs over Arrow batches with no loop over rows.

Defined results: a null url, or one without "://", has an empty host and path, no rule, and the verdict the model gives
to empty input (the built-in table labels it "allow"). Repeated rows and ties are judged one by one, other columns
are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAMS = (3, 4, 5)
BITS = 16
#: (host, path, verdict); a rule fits the host and its subdomains if the path starts with the rule's.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

BAD_WORDS = "cheap pills casino spam farm viagra porn xxx loan payday replica prize lottery warez torrent crack keygen adult escort betting jackpot cialis clickbait phish malware freemoney bonus slots free win bets click ads track".split()
GOOD_WORDS = "news library museum school college garden travel recipes science history music review journal weather sports health city council archive forum support shop books teacher kitchen bridge nature photo".split()
GOOD_PATHS = "article about index post story page help guide lesson report event item".split()
BAD_PATHS = "buy win free order deal bonus promo xxx pills casino".split()


def labelled_urls(n: int = 1600, seed: int = 7) -> list[tuple[str, str, int]]:
    """A table of (host, path, label), half of it label 1 (block), made by rule from the word lists above, with some rows of label 0 for no url.

    Hosts of label 0 are a known plain word or a made-up name, those of label 1 join two words of the list of bad ones, or
    one of those with a made-up name. Top-level domains, prefixes and languages are dealt evenly, so they carry no sign.
    """
    rng, out = random.Random(seed), []

    def made_up() -> str:
        return "".join(rng.choice("bcdfghklmnprstvwth") + rng.choice("aeiou") + rng.choice(["", "n", "r", "s", "th", "nd"]) for _ in range(rng.randint(2, 4)))

    def odd() -> str:
        return "".join(rng.choice("th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()) for _ in range(rng.randint(2, 4)))

    for k in range(n):
        bad = k % 2
        if bad:
            a, b = rng.sample(BAD_WORDS, 2)
            name = rng.choice([f"{a}-{b}", f"{a}{b}", f"{a}-{made_up()}", f"{odd()}-{b}", f"{b}{rng.randint(1, 99)}"])
            path = rng.choice(BAD_PATHS + GOOD_PATHS)
        else:
            a, b = rng.sample(GOOD_WORDS, 2)
            name = rng.choice([made_up(), odd(), odd(), a, f"{a}-{b}", f"{a}{made_up()}"])
            path = rng.choice(GOOD_PATHS)
        host = rng.choice(["", "", "www.", "m.", "blog."]) + name + rng.choice([".com", ".net", ".org", ".example.com", ".example.net", ".example.org"])
        tail = rng.choice([f"/{path}", f"/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randint(1, 999)}", f"/{rng.choice(['en', 'de', 'fr', 'es'])}/{path}.html", "", "/"])
        out.append((host, tail, bad))
    return out + [("", "", 0)] * (n // 100)


def grams(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of every row, computed over the bytes of all rows at once."""
    parts = [b"\x02" + h.encode("utf-8", "replace") + b"\x03" + p.encode("utf-8", "replace") + b"\x04" for h, p in zip(hosts, paths, strict=True)]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
    row = np.repeat(np.arange(len(parts)), size)
    start = np.cumsum(size) - size
    split = start + np.fromiter((len(h.encode("utf-8", "replace")) + 1 for h in hosts), np.int64, len(hosts))
    in_path = (np.arange(len(data)) >= split[row]).astype(np.uint64) if len(data) else data
    rows, buckets = [], []
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x100000001B3) + data[i : i + m]
        h = (h * np.uint64(2) + in_path[:m]) * np.uint64(0x9E3779B97F4A7C15)
        whole = row[:m] == row[n - 1 :]
        rows.append(row[:m][whole])
        buckets.append((h >> np.uint64(64 - BITS)).astype(np.int64)[whole])
    empty = np.zeros(0, np.int64)
    return (np.concatenate(rows), np.concatenate(buckets)) if rows else (empty, empty)


def fit(urls: list[tuple[str, str, int]], epochs: int = 200, rate: float = 8.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic regression, both by full-batch gradient steps."""
    hosts, paths, label = zip(*urls, strict=True)
    row, bucket = grams(list(hosts), list(paths))
    y = np.array(label, np.float64)
    scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(y)), 1))
    w, bias = np.zeros(1 << BITS), 0.0
    for _ in range(epochs):
        z = np.bincount(row, w[bucket], len(y)) * scale + bias
        err = (1 / (1 + np.exp(-z)) - y) / len(y)
        w -= rate * 10 * np.bincount(bucket, (err * scale)[row], len(w)) + decay * w
        bias -= rate / 8 * err.sum()
    return w.astype(np.float32), bias


def probability(hosts: list[str], paths: list[str], w: np.ndarray, bias: float) -> np.ndarray:
    row, bucket = grams(hosts, paths)
    m = np.bincount(row, minlength=len(hosts))
    z = np.bincount(row, w[bucket], len(hosts)) / np.sqrt(np.maximum(m, 1)) + bias
    return 1 / (1 + np.exp(-z))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty without "://"."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; of two as long, the first in the list. The list is a short setting."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1]))[::-1]:
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def judge_urls(pages: DataFrame, url: str = "url", rules=RULES, urls: list[tuple[str, str, int]] | None = None, threshold: float = 0.5) -> DataFrame:
    """Adds host, path, rule, model_score and verdict to every row; columns of these names are replaced."""
    w, bias = fit(urls or labelled_urls())
    host, path = host_and_path(F.col(url))

    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for h, p in batches:
            yield pd.Series(probability(h.tolist(), p.tolist(), w, bias))

    scored = F.pandas_udf(score, "double")
    out = pages.withColumns({"host": host, "path": path}).withColumn("model_score", scored("host", "path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    return out.withColumns({"rule": rule, "verdict": F.coalesce(verdict, F.when(F.col("model_score") >= threshold, "block").otherwise("allow"))})


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict", "model_score")
