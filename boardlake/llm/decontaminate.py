"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Everything is DataFrame functions. Words are the runs between white space in lower case without ASCII punctuation,
shingles are five of them, hashed. A document holds an item if it has 80 % or more of the item's distinct shingles.

Items are partitioned by size, for an item is short and a document may be long, so their Jaccard similarity says nothing.
Partition p has the items of 2**p up to 2**(p+1) - 1 shingles, and a MinHash signature length of its own: an item keeps its
smallest hashes, more than 20 % of the partition's upper bound, so a document with 80 % of the item cannot miss them all;
where that would be over `MOST` hashes it is `MOST`, which all miss with a probability of 0.2 ** MOST (6e-12). A document's
MinHash for all partitions is its shingles up to the greatest hash in any signature, so with long items alone few of them
are looked up. They meet a filter of bounded size in place, and only those that pass it are joined with the signatures,
which gives candidate pairs. Exact containment then decides: the distinct shingles of the candidate documents meet those of
the items, and the common ones are counted for each pair, so no document is copied for its items.

Defined results: null and empty texts, and texts of under five words, have no shingles: they hold nothing and are in
nothing. Rows with equal text and id are each reported; null ids are kept. Equal items are each reported. An empty table
on either side gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, KeyFilter, let, row_key, table, written

SHINGLE = 5
THRESHOLD = 0.8
MOST = 16
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def normal_words(text: Column) -> Column:
    """Words in lower case, without ASCII punctuation."""
    flat = F.translate(F.lower(F.coalesce(text, F.lit(""))), SPACES + PUNCTUATION, " " * len(SPACES))
    return F.array_remove(F.split(flat, " "), "")


def shingles(words: Column) -> Column:
    """The hashes of every SHINGLE words in a row, as an array with repeats."""
    at = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))
    return let(words, lambda w: F.when(F.size(w) < SHINGLE, F.array().cast("array<bigint>")).otherwise(at(w)))


def signatures(items: DataFrame, threshold: float) -> DataFrame:
    """(part, item_key, g): the smallest hashes of each item, as many as its size partition needs."""
    part = F.floor(F.log2(F.size("grams"))).cast("int")
    upper = F.pow(F.lit(2.0), F.col("part") + 1) - 1
    need = F.least(F.floor((1 - threshold) * upper + 1e-9) + 1, F.lit(MOST), F.size("grams")).cast("int")
    some = items.filter(F.size("grams") > 0).withColumn("part", part)
    return some.select("part", "item_key", F.explode(F.slice(F.sort_array("grams"), F.lit(1), need)).alias("g"))


def find_items(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(_k, _h, doc_id, item_id, n_shared, n_shingles, containment) for each row of docs and each item that it holds."""
    items = benchmark.select("item_id", F.array_distinct(shingles(normal_words(F.col("text")))).alias("grams"))
    items = items.withColumn("item_key", F.xxhash64(F.col("item_id").isNull(), F.coalesce("item_id", F.lit(-1)), F.col("grams")))
    items = written(items, "benchmark-items")
    single = items.dropDuplicates(["item_key"])
    wanted = written(signatures(single, threshold), "benchmark-signatures")
    largest = wanted.agg(F.max("g")).first()[0]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *row_key("doc_id", "text"))
    sketch = F.filter(shingles(normal_words(F.col("text"))), lambda g: g <= F.lit(largest).cast("long"))
    looked_up = KeyFilter(wanted, ["g"]).candidates(rows.select("_k", "_h", F.explode(sketch).alias("g")))
    pairs = written(looked_up.join(wanted, "g").select("_k", "_h", "item_key").distinct(), "benchmark-candidates")
    keys = written(pairs.select("_k", "_h").distinct(), "benchmark-documents")
    near = KeyFilter(keys, ["_k", "_h"]).candidates(rows).groupBy("_k", "_h").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("copies"))
    near = near.join(keys, ["_k", "_h"], "left_semi").select("_k", "_h", "doc_id", "copies", F.explode(F.array_distinct(shingles(normal_words(F.col("text"))))).alias("g"))
    parts = written(single.select("item_key", F.size("grams").cast("long").alias("n_shingles"), F.explode("grams").alias("g")), "benchmark-shingles")
    both = KeyFilter(parts, ["g"]).candidates(near).join(parts, "g").groupBy("_k", "_h", "item_key").agg(F.first("doc_id").alias("doc_id"), F.first("copies").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("n_shared"))
    both = both.filter(F.col("n_shared") >= threshold * F.col("n_shingles") - 1e-9).join(pairs, ["_k", "_h", "item_key"], "left_semi")
    out = both.join(items.select("item_key", "item_id"), "item_key").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select("_k", "_h", "doc_id", "item_id", "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold an item. Only rows that may hold one cross the network."""
    bad = written(find_items(docs, benchmark).select("_k", "_h").distinct(), "benchmark-contaminated")
    flagged = KeyFilter(bad, ["_k", "_h"]).flagged(docs.select(F.struct("*").alias("_row"), *row_key("doc_id", "text")))
    some = flagged.filter("_maybe").join(bad, ["_k", "_h"], "left_anti")
    return flagged.filter("not _maybe").select("_row.*").unionByName(some.select("_row.*"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_shingles", "containment")


_BLANKS = " || ".join(f"chr({ord(c)})" for c in SPACES)
_MARKS = PUNCTUATION.replace("'", "''")
_WORDS = "[x for x in string_split(translate(lower(coalesce(text, '')), " + _BLANKS + f" || '{_MARKS}', '     '), ' ') if x <> '']"
ORACLE = f"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
dg as (select distinct doc_id, array_to_string(w[i:i+4], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from d where len(w) >= 5)),
bg as (select distinct item_id, array_to_string(w[i:i+4], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 3)) as i from b where len(w) >= 5)),
n as (select item_id, count(*) as n_shingles from bg group by item_id)
select doc_id, item_id, count(*) as n_shared, any_value(n_shingles) as n_shingles, count(*) / any_value(n_shingles) as containment
from dg join bg using (g) join n using (item_id) group by doc_id, item_id having count(*) >= 0.8 * any_value(n_shingles) - 1e-9
"""
