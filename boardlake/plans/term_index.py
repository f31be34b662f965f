"""A stored inverted index over posts, kept in segments and searched for phrases and boolean conditions.

A segment holds the postings of the posts of one ingest, in ranges of terms and sorted by term and post, so the statistics of
its files tell which of them hold a term or the terms with a prefix, and post numbers and positions are stored as differences.
An ingest adds a segment. As many segments of one size class as `FANOUT` are merged into one, so a posting is written again
once for each size class, and there are as many of these as the index has digits to base `FANOUT` over `PENDING`.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.search import INDEX, SIMPLE, Condition, Config, Follow, condition, inverted_index
from boardlake.operators.dedup import KEY
from boardlake.plans.commits import Commits

#: Bytes up to which segments are of the first size class, as the list of pending entries of a database index; fixed value.
PENDING = 262_144 << 10
FANOUT = 8
#: Postings of one file of a segment, about.
FILE_ROWS = 4_000_000


@dataclass
class TermIndex:
    """The terms of posts with their positions. `segments` are (path, bytes); without them those of the folder's last commit are read."""

    spark: SparkSession
    folder: str
    config: Config = SIMPLE
    segments: list[tuple[str, int]] | None = None
    commits: Commits = field(init=False)

    def __post_init__(self):
        self.commits = Commits(self.spark, self.folder)
        if self.segments is None:
            self.segments = [tuple(s) for s in self.commits.latest()[1].get("segments", [])]

    def _write(self, rows: DataFrame, n: int) -> tuple[str, int]:
        path = self.commits.new_part("segments")
        # a frequent term is spread over several files by post
        rows = rows.repartitionByRange(n // FILE_ROWS + 1, "term", *KEY).sortWithinPartitions("term", *KEY)
        rows.write.option("parquet.writer.version", "v2").parquet(path)
        return path, self.commits.size(path)

    def added(self, posts: DataFrame) -> TermIndex:
        """The index with a segment of these posts, written but not committed."""
        return self.with_postings(inverted_index(posts, self.config))

    def with_postings(self, postings: DataFrame) -> TermIndex:
        """The index with a segment of these postings."""
        staged = self.commits.new_part("staged")
        postings.write.parquet(staged)  # ranges are sampled before they are written, and texts are read once
        rows = self.spark.read.schema(INDEX).parquet(staged)
        out = TermIndex(self.spark, self.folder, self.config, [*self.segments, self._write(rows, rows.count())])
        self.commits.delete(staged)
        return out

    def size_class(self, size: int) -> int:
        k = 0
        while size > PENDING * FANOUT**k:
            k += 1
        return k

    def merged(self) -> TermIndex:
        """The index with the segments of each full size class in one, written but not committed."""
        segments, k = list(self.segments), 0
        while k <= max((self.size_class(s) for _, s in segments), default=-1):
            own = [s for s in segments if self.size_class(s[1]) == k]
            if len(own) >= FANOUT:
                rows = self.spark.read.schema(INDEX).parquet(*[p for p, _ in own])
                segments = [s for s in segments if s not in own] + [self._write(rows, rows.count())]
            k += 1
        return TermIndex(self.spark, self.folder, self.config, segments)

    def _committed(self) -> TermIndex:
        number, _ = self.commits.latest()
        self.commits.commit({"segments": self.segments}, number)
        return self

    def build(self, posts: DataFrame) -> TermIndex:
        """Writes the index of these posts; an older one in the folder is replaced."""
        out = TermIndex(self.spark, self.folder, self.config, []).added(posts)._committed()
        self.commits.sweep(["segments"], {p for p, _ in out.segments})
        return out

    def add(self, posts: DataFrame) -> TermIndex:
        """The index with these posts too, which it must not hold yet."""
        return self.added(posts).merged()._committed()

    def read(self) -> DataFrame:
        paths = [p for p, _ in self.segments]
        return self.spark.read.schema(INDEX).parquet(*paths) if paths else self.spark.createDataFrame([], INDEX)

    def drop(self) -> None:
        self.commits.delete(self.folder)

    def status(self) -> DataFrame:
        """(segment, postings, terms, files, bytes) of the stored index."""
        rows = self.read().select("term", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        rows = rows.withColumn("segment", F.element_at(F.split("file", "/"), -2))
        files = rows.groupBy("segment", "file").agg(F.max("size").alias("size"), F.count("*").alias("postings"))
        terms = rows.groupBy("segment").agg(F.count_distinct("term").alias("terms"))
        return files.groupBy("segment").agg(F.sum("postings").alias("postings"), F.count("*").alias("files"), F.sum("size").alias("bytes")).join(terms, "segment")

    def postings(self, lexemes: list[str], prefixes: list[str] = ()) -> DataFrame:
        """(site, board, post_no, term, positions) of these terms and of those with these prefixes; the scan is told both."""
        tests = [F.col("term").isin(lexemes)] * bool(lexemes) + [F.col("term").startswith(p) for p in prefixes]
        return self.read().filter(reduce(Column.__or__, tests, F.lit(False)))

    def _judged(self, what: Condition) -> DataFrame:
        """(site, board, post_no, fits) of the posts that hold any term of a condition, by one aggregation over their postings."""
        words = {(w, p) for leaf in what.leaves for w, p in leaf.lexemes}
        rows = self.postings([w for w, p in words if not p], [w for w, p in words if p])
        test = lambda w, p: F.col("term").startswith(w) if p else F.col("term") == w
        name = {word: f"_at{k}" for k, word in enumerate(sorted(words))}
        in_chains = {word for leaf in what.leaves if len(leaf.lexemes) > 1 for word in leaf.lexemes}
        kept = [(F.flatten(F.collect_list(F.when(test(*word), F.col("positions")))) if word in in_chains else F.max(test(*word))).alias(at) for word, at in name.items()]
        found = rows.groupBy(*KEY).agg(*kept)
        held = {f"_leaf{k}": self._held([F.col(name[w]) for w in leaf.lexemes], leaf, leaf.lexemes[0] in in_chains) for k, leaf in enumerate(what.leaves)}
        return found.withColumns(held).select(*KEY, F.expr(what.sql).alias("fits"))

    @staticmethod
    def _held(at: list[Column], leaf: Follow, listed: bool) -> Column:
        if len(at) == 1:
            return F.size(at[0]) > 0 if listed else at[0]
        # each list moved to where the first word would be; the words follow one another if all lists share a place
        moved = [F.transform(a, _less(sum(leaf.gaps[:k]))) for k, a in enumerate(at)]
        return F.size(reduce(F.array_intersect, moved)) > 0

    def find(self, text: str, posts: DataFrame) -> DataFrame:
        """The posts that fulfil a condition such as `fat & (rat | !cat:*)`, from the postings of its terms alone; posts with none of them are looked at only if the condition holds for such."""
        return self.matching(condition(text, self.config), posts)

    def matching(self, what: Condition, posts: DataFrame) -> DataFrame:
        judged = self._judged(what)
        if what.holds_without_terms(self.spark):
            return posts.join(judged.filter(~F.col("fits")).select(*KEY), KEY, "left_anti")
        return posts.join(judged.filter("fits").select(*KEY), KEY, "left_semi")

    def phrase(self, phrase: str) -> DataFrame:
        """The keys of the posts in which the phrase's lexemes follow one another; stop words count as distance. Without a lexeme there is none."""
        leaf = Follow.of(re.findall(r"[^\W_]+", phrase.lower()), self.config)
        if leaf is None:
            return self.read().select(*KEY).limit(0)
        return self._judged(Condition((leaf,), "_leaf0")).filter("fits").select(*KEY)


def _less(by: int):
    return lambda place: place - by
