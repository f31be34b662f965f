"""N-gram Jaccard join: a chosen-path join over sets of word shingles, verified exactly.

Words are the runs between ASCII white space in lower case without ASCII punctuation; a text's set holds its runs of five
words (all its words if it has fewer), hashed to 64 bits. Texts with equal sets are one class, and copies are never
expanded into pairs.

1. Each set is embedded as `COORDS` MinHash values; value i is the token (i, value), and similar sets share tokens.
2. Chosen paths: in each run, a node samples every token with a chance of 1 / (THRESHOLD * COORDS) by a hash of the node
   and the token, so sets that share a sampled token meet in a child. Buckets of over `SMALL` sets are split again by
   their own samples, up to `DEPTH` levels, unless they have stopped shrinking: a child with over half of its parent's
   sets is a cluster of near copies, which no token divides.
3. Runs are repeated until the target recall (`RECALL`): a pair of similarity 0.8 shares one sampled token at each node on
   average, so a run brings it to a common leaf of depth d with the chance of a branching process to live that long, and
   `runs_for` gives the runs that this takes. The first runs are those for depth 1; sets that came to deeper buckets are
   run again as often as the depth that was reached demands.
4. Leaves of up to `BLOCK` sets are compared by brute force on the embedding and give only the edges of a spanning forest.
   In larger ones, which are clusters that no token divides, sets with two neighbouring values in common are connected with
   the least of them, which misses none and has no pairs. The components are a superset of the linked groups: two sets of
   similarity 0.8 fall short of `LEAST` equal values once in 20,000.
5. The full sets of each component go, in blocks of `BLOCK_GRAMS` shingles and `BLOCK_SETS` sets, through an exact count of
   common shingles. Sets that share the same shingles with others are one kind, and only kinds are compared. It gives the
   number of links of each class and the edges of the final components.

Texts do not cross the network except those of classes in a component: a filter of bounded size over their keys is tested
where the texts are read. No task gets more than two blocks, no row stands for a pair of texts, and nothing is dropped:
long lists are dealt to more tasks, and a bucket at the last level is a leaf.

Defined results: null and empty texts have the empty set; they are copies of each other and link to nothing else. Rows are
told apart by id and a hash of the text. A class is named by the least doc_id of its documents, null if all are null. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil, exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import KeyFilter, discard, row_key, table, written
from .components import components

SHINGLE = 5
#: 0.8 as a fraction.
OVER, UNDER = 4, 5
COORDS = 48
LEAST = 27
#: Chance that two sets of similarity 0.8 meet in a leaf.
RECALL = 0.9999
DEPTH = 6
SMALL = 1024
BLOCK = 1024
BLOCK_GRAMS, BLOCK_SETS = 300_000, 30_000
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
MULT = np.uint64(0x9E3779B97F4A7C15)
U64 = np.uint64


def gram_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.lower().encode("utf-8", "replace").translate(None, PUNCTUATION).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(len(w) - SHINGLE + 1, 1)
    h = np.full(n, min(len(w), SHINGLE), np.uint64)
    for k in range(min(SHINGLE, len(w))):
        h = (h * U64(0x100000001B3)) + w[k : k + n]
    h ^= h >> U64(31)
    return np.unique(h * MULT)


def embed(sets: list[np.ndarray]) -> np.ndarray:
    """COORDS values of 32 bits for each set; those of the empty set are 0. With fewer bits unrelated sets would share tokens, the more the larger the corpus."""
    out = np.zeros((len(sets), COORDS), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    flat = np.concatenate([sets[i] for i in full])
    start = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
    for k in range(COORDS):
        a = U64((2 * k + 3) * int(MULT) % 2**64 | 1)
        h = flat * a
        h ^= h >> U64(32)
        low = np.minimum.reduceat(h * U64(0xD6E8FEB86659FD93), start)
        out[full, k] = (low * MULT >> U64(32)).astype(np.uint32)
    return out


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text: its keys, the digest and size of its set, and the embedding."""
    for batch in batches:
        texts = batch.column("text")
        digest, size, sketch = [], [], []
        for lo in range(0, batch.num_rows, 200):
            sets = [gram_set(t) for t in texts[lo : lo + 200].to_pylist()]
            digest += [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            size += map(len, sets)
            sketch += [r.tobytes() for r in embed(sets)]
        yield pa.RecordBatch.from_arrays([batch.column("_k"), batch.column("_h"), batch.column("doc_id"), pa.array(digest, pa.binary()), pa.array(size, pa.int32()), pa.array(sketch, pa.binary())], names=["_k", "_h", "doc_id", "cid", "n", "sketch"])


def runs_for(recall: float, depth: int) -> int:
    """How many runs bring a pair at the threshold to a common leaf of this depth with a chance of `recall`.

    Of the tokens that the pair shares a node samples one on average, as good as Poisson, so the chance q to meet at depth
    d follows q = 1 - exp(-q of depth d - 1).
    """
    q = 1.0
    for _ in range(depth):
        q = 1 - exp(-q)
    return ceil(log(1 - recall) / log(1 - q))


def choose(runs: range | None) -> Callable:
    """Children of nodes: rows (path, cid, of) for every sampled token of each set, with the size `of` of the parent; with `runs` the parents are the roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = U64(int(2**64 / (COORDS * OVER / UNDER)))
        coord = np.arange(1, COORDS + 1, dtype=np.uint64) * MULT
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                if not part.num_rows:
                    continue
                sketch = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint32).reshape(-1, COORDS).astype(np.uint64)
                token = sketch + U64(1) + coord
                starts = [np.full(len(sketch), r + 1, np.uint64) for r in runs] if runs is not None else [part.column("path").to_numpy().view(np.uint64)]
                for node in starts:
                    h = (token ^ (node[:, None] * U64(0xC2B2AE3D27D4EB4F))) * U64(0xFF51AFD7ED558CCD)
                    h ^= h >> U64(33)
                    h *= U64(0xC4CEB9FE1A85EC53)
                    h ^= h >> U64(29)
                    row, at = np.nonzero(h * MULT < limit)
                    if len(row):
                        yield pa.RecordBatch.from_arrays([pa.array((h[row, at] * U64(3)).view(np.int64)), *[part.column(c).take(pa.array(row)) for c in ("cid", "g")]], names=["path", "cid", "of"])

    return run


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches that are sorted by the keys; a key's rows are bounded by what was dealt to it."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) if not pa.types.is_binary(batch.schema.field(k).type) else np.array(batch.column(k).to_pylist(), object) for k in keys]
        cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1 if batch.num_rows > 1 else np.zeros(0, np.int64)
        bounds = [0, *cut.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:], strict=False):
            key = tuple(c[a] for c in cols)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def forest(close: Callable[[int], np.ndarray], m: int) -> list[tuple[int, int]]:
    """Edges (root, member) of a spanning forest; close(i) gives the members that i is close to."""
    left, out = np.ones(m, bool), []
    for root in range(m):
        if not left[root]:
            continue
        left[root], todo = False, [root]
        while todo:
            got = close(todo.pop())
            new = got[left[got]]
            left[new] = False
            out += [(root, int(x)) for x in new]
            todo += new.tolist()
    return out


def compare_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = [], []

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    for rows in runs_of(batches, ["path"]):
        if rows.num_rows < 2:
            continue
        cid = rows.column("cid").to_pylist()
        sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint32).reshape(-1, COORDS)
        for i, j in forest(lambda k, s=sketch: np.flatnonzero((s == s[k]).sum(1) >= LEAST), len(cid)):
            x, y = cid[i], cid[j]
            if x != y:
                a.append(min(x, y)), b.append(max(x, y))
        if len(a) > 20_000:
            yield flush()
            a, b = [], []
    if a:
        yield flush()


def coordinate_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, cid) for each two neighbouring values of each set: their place and both values, hashed."""
    place = np.arange(1, COORDS // 2 + 1, dtype=np.uint64) * MULT
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            part = batch.slice(lo, 2000)
            sketch = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint32).reshape(-1, COORDS).astype(np.uint64)
            h = (sketch[:, ::2] << U64(32) | sketch[:, 1::2]) * U64(0xD6E8FEB86659FD93)
            h = (h ^ h >> U64(32)) * MULT + place
            h = (h ^ h >> U64(29)) * U64(0xFF51AFD7ED558CCD)
            row = np.repeat(np.arange(part.num_rows), COORDS // 2)
            yield pa.RecordBatch.from_arrays([pa.array((h ^ h >> U64(32)).reshape(-1).view(np.int64)), part.column("cid").take(pa.array(row))], names=["key", "cid"])


def star_edges(sets: DataFrame) -> DataFrame:
    """Edges (a, b) that connect those of different sets (cid, sketch) which have two neighbouring values in common, each with the least of them.

    Two sets with LEAST of COORDS equal values have at least LEAST - COORDS / 2 of the COORDS / 2 places with both values
    equal, so none is missed, and the rows are as many as the sets times COORDS / 2, however large a leaf is."""
    keys = sets.mapInArrow(coordinate_pairs, "key long, cid binary")
    stars = keys.groupBy("key").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).filter(F.col("a") < F.col("z")).drop("z")
    # a set names its least root alone, and the least root the set's others, of which many sets have the same
    per = keys.join(stars, "key").groupBy("cid").agg(F.min("a").alias("a"), F.collect_set("a").alias("roots"))
    return per.select("a", F.explode(F.array_union("roots", F.array("cid"))).alias("b")).filter(F.col("a") < F.col("b"))


def dealt(rows: DataFrame, keys: list[str], blocks: str, own: str) -> DataFrame:
    """Each row once for every pair of blocks that its own is in, dealt and sorted by keys, p and q."""
    other = F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    out = rows.withColumn("_o", other).withColumns({"p": F.least(own, "_o"), "q": F.greatest(own, "_o")}).drop("_o")
    return out.repartition(*keys, "p", "q").sortWithinPartitions(*keys, "p", "q")


def split_paths(sets: DataFrame, runs: range, found: list[DataFrame], clusters: list[DataFrame]) -> tuple[int, DataFrame | None]:
    """Does the runs over sets (cid, sketch) and adds the edges of their leaves to found, repeated where leaves agree, and the cids in leaves of over BLOCK sets to clusters. Gives the depth reached and the sets that were in a bucket that was split.

    Paths travel with the class alone; the embedding joins only those that another class shares.
    """
    nodes, deep, shared = sets.withColumn("g", F.lit(2**62)), None, None
    for depth in range(DEPTH):
        level = written(nodes.mapInArrow(choose(None if depth else runs), "path long, cid binary, of long"), f"jaccard-level{depth}")
        if shared is not None:
            discard(shared)  # the nodes of this level came from it
        sizes = level.groupBy("path").agg(F.count("*").alias("g"), F.max("of").alias("of")).filter(F.col("g") > 1)
        shared = written(level.drop("of").join(sizes, "path").join(sets, "cid"), f"jaccard-shared{depth}")
        discard(level)
        last = depth == DEPTH - 1
        split = (F.col("g") > SMALL) & (2 * F.col("g") <= F.col("of"))
        leaves = shared if last else shared.filter(~split)
        small, large = leaves.filter(F.col("g") <= BLOCK), leaves.filter(F.col("g") > BLOCK)
        small = small.select("path", "cid", "sketch").repartition("path").sortWithinPartitions("path")
        found.append(written(small.mapInArrow(compare_leaves, "a binary, b binary"), f"jaccard-edges{depth}"))
        clusters.append(written(large.select("cid"), f"jaccard-clusters{depth}"))
        nodes = shared.filter(split).select("path", "cid", "sketch", "g")
        if last or nodes.isEmpty():
            break
        if deep is None:
            deep = written(nodes.dropDuplicates(["cid"]).select("cid", "sketch"), "jaccard-deep")
    discard(shared)
    return depth + 1, deep


def chosen_path_edges(classes: DataFrame, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) that connect the classes that may be similar. Large leaves of all levels and runs are done at once, for what connects their sets does not depend on the leaf."""
    found: list[DataFrame] = []
    clusters: list[DataFrame] = []
    every = classes.filter(F.col("n") > 0).select("cid", "sketch")
    sets, done, depth = every, 0, 1
    while True:
        want = runs_for(recall, depth)
        reached, deep = split_paths(sets, range(done, want), found, clusters)
        if deep is None or reached <= depth:
            break
        sets, done, depth = deep, want, reached
    large = reduce(DataFrame.unionByName, clusters).distinct()
    if not large.isEmpty():
        found.append(written(star_edges(large.join(every, "cid")), "jaccard-stars"))
    return reduce(DataFrame.unionByName, found)


def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            grams = [gram_set(t).tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in ("group", "cid", "copies", "nb", "own")] + [pa.array(grams, pa.binary())], names=["group", "cid", "copies", "nb", "own", "grams"])


def count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each class of a pair of blocks: links to texts and to rows, and one edge to the root of its linked group."""
    out: list[list] = [[], [], [], []]

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())], names=["cid", "texts", "rows", "root"])

    for rows in runs_of(batches, ["group", "p", "q"]):
        m = rows.num_rows
        if m < 2:
            continue
        cid, copies = rows.column("cid").to_pylist(), rows.column("copies").to_numpy()
        own, p, q = rows.column("own").to_numpy(), rows.column("p")[0].as_py(), rows.column("q")[0].as_py()
        grams = [np.frombuffer(g, np.uint64) for g in rows.column("grams").to_pylist()]
        size = np.array([len(g) for g in grams])
        first = np.cumsum(size) - size
        flat = np.concatenate(grams)
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        begin = np.flatnonzero(new)
        many = np.diff(np.append(begin, len(ordered)))
        slot = np.empty(len(flat), np.int64)
        slot[order] = np.cumsum(new) - 1
        # what sets have in common are grams that more than one of them has; those with the same such grams and size have
        # the same in common with each other set, so they are one kind, and kinds are compared instead of sets
        shared = many[slot] > 1
        kind_of, kinds = np.empty(m, np.int64), {}
        for i in range(m):
            mine = slot[first[i] : first[i] + size[i]]
            kind_of[i] = kinds.setdefault((mine[shared[first[i] : first[i] + size[i]]].tobytes(), int(size[i]), int(own[i])), len(kinds))
        k = len(kinds)
        rep = np.full(k, m)
        np.minimum.at(rep, kind_of, np.arange(m))
        sets_of, rows_of = np.bincount(kind_of, minlength=k), np.bincount(kind_of, copies, k).astype(np.int64)
        core = [slot[first[i] : first[i] + size[i]][shared[first[i] : first[i] + size[i]]] for i in rep.tolist()]
        n_core, k_size, k_own = np.array(list(map(len, core))), size[rep], own[rep]
        listed = np.concatenate(core)
        order = np.argsort(listed, kind="stable")
        owner, length = np.repeat(np.arange(k), n_core)[order], np.bincount(listed, minlength=len(begin))
        begin = np.cumsum(length) - length
        label = np.arange(k)  # the first kind of each linked group so far
        texts, linked = np.zeros(k, np.int64), np.zeros(k, np.int64)
        alike = (p == q) & (sets_of > 1) & (UNDER * n_core >= OVER * (2 * k_size - n_core))
        for i in range(k):
            count, start = length[core[i]], begin[core[i]]
            where = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
            other, common = np.unique(owner[where], return_counts=True)
            hit = other[(UNDER * common >= OVER * (k_size[other] + k_size[i] - common)) & (other != i)]
            if p != q:
                hit = hit[k_own[hit] != k_own[i]]
            texts[i], linked[i] = sets_of[hit].sum() + alike[i] * (sets_of[i] - 1), rows_of[hit].sum()
            if len(hit):
                groups = np.unique(np.append(label[hit], label[i]))
                if len(groups) > 1:
                    label[np.isin(label, groups)] = groups[0]
        for i in np.flatnonzero(texts[kind_of]):
            t = kind_of[i]
            out[0].append(cid[i]), out[1].append(int(texts[t])), out[2].append(int(linked[t] + alike[t] * (rows_of[t] - copies[i]))), out[3].append(cid[rep[label[t]]])
        if len(out[0]) > 20_000:
            yield flush()
            for x in out:
                x.clear()
    if out[0]:
        yield flush()


def linked_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, classes), both written. rows: _k, _h, doc_id and cid for each row. classes: for each cid its copies, least id,
    representative row (_k, _h), the label of its linked group, and its links to other texts and to their rows."""
    keyed = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *row_key(key, text))
    rows = written(keyed.mapInArrow(describe, "_k long, _h long, doc_id long, cid binary, n int, sketch binary"), "jaccard-rows")
    classes = rows.groupBy("cid").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.min(F.struct("_k", "_h")).alias("rep"), F.max("n").alias("n"), F.max("sketch").alias("sketch"))
    classes = written(classes.select("cid", "copies", "least", "rep._k", "rep._h", "n", "sketch"), "jaccard-classes")
    candidates = components(chosen_path_edges(classes), "jaccard-candidates")
    some = classes.join(candidates.select(F.col("v").alias("cid"), F.col("label").alias("group")), "cid").drop("sketch")
    blocks = some.groupBy("group").agg(F.ceil(F.greatest(F.sum("n") / BLOCK_GRAMS, F.count("*") / BLOCK_SETS)).cast("int").alias("nb"))
    some = some.join(blocks, "group").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
    some = written(some.select("group", "cid", "copies", "nb", "own", "_k", "_h"), "jaccard-members")
    texts = KeyFilter(some, ["_k", "_h"]).candidates(keyed.drop("doc_id")).dropDuplicates(["_k", "_h"])
    texts = texts.join(some, ["_k", "_h"]).select("text", "group", "cid", "copies", "nb", "own")
    sets = texts.mapInArrow(set_rows, "group binary, cid binary, copies long, nb int, own int, grams binary")
    found = dealt(sets, ["group"], "nb", "own").mapInArrow(count_links, "cid binary, texts long, rows long, root binary")
    found = written(found, "jaccard-links")
    labels = components(found.filter(F.col("cid") != F.col("root")).select(F.col("cid").alias("a"), F.col("root").alias("b")), "jaccard-groups")
    links = found.groupBy("cid").agg(F.sum("texts").alias("texts"), F.sum("rows").alias("rows"))
    out = classes.drop("sketch").join(labels.select(F.col("v").alias("cid"), "label"), "cid", "left").join(links, "cid", "left")
    out = out.withColumns({"label": F.coalesce("label", "cid"), "texts": F.coalesce("texts", F.lit(0)), "rows": F.coalesce("rows", F.lit(0))})
    out = written(out, "jaccard-linked")
    discard(classes, some, found)
    return rows.select("_k", "_h", "doc_id", "cid"), out


def link_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row of docs: doc_id, class_id, n_links (other rows that it is similar to, copies included), n_text_links (different sets that it is similar to) and n_copies (rows with its own set)."""
    rows, classes = linked_classes(docs, key, text)
    named = classes.groupBy("label").agg(F.min("least").alias("class_id"))
    per = classes.join(named, "label").select("cid", "class_id", (F.col("rows") + F.col("copies") - 1).alias("n_links"), F.col("texts").alias("n_text_links"), F.col("copies").alias("n_copies"))
    return rows.join(written(per, "jaccard-result"), "cid").select("doc_id", "class_id", "n_links", "n_text_links", "n_copies")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each group of linked classes: the one with the least key; of rows equal in id and text, any one.

    Only rows whose key may have to go cross the network: most rows pass the filter of those keys where they are read.
    """
    rows, classes = linked_classes(docs, key, text)
    kept = classes.groupBy("label").agg(F.min(F.struct("_k", "_h")).alias("rep")).select("rep._k", "rep._h", F.lit(True).alias("_keep"))
    touched = rows.groupBy("_k", "_h").agg(F.count("*").alias("_n")).join(kept, ["_k", "_h"], "left")
    touched = written(touched.filter(F.col("_keep").isNull() | (F.col("_n") > 1)), "jaccard-touched")
    flagged = KeyFilter(touched, ["_k", "_h"]).flagged(docs.select(F.struct("*").alias("_row"), *row_key(key, text)))
    some = flagged.filter("_maybe").dropDuplicates(["_k", "_h"]).join(touched, ["_k", "_h"], "left")
    some = some.filter(F.col("_n").isNull() | F.col("_keep").isNotNull())
    return flagged.filter("not _maybe").select("_row.*").unionByName(some.select("_row.*"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(table(spark, sf_dir, "documents"))
