"""A store of posts in a folder that grows source by source, in the order of a lock list, and is always whole.

Each source adds a part of posts, one of the summary, keys and a segment of each index. They are written first and named by
one commit last, so a run that stops anywhere leaves the store as it was, and the next run does that source again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.functions.search import ENGLISH, SIMPLE, Config, stemmed_index
from boardlake.operators import aggregates, dedup, filters
from boardlake.plans.commits import Commits
from boardlake.plans.key_store import KeyStore
from boardlake.plans.store import PostStore
from boardlake.plans.term_index import TermIndex

CONFIGS = {c.name: c for c in (SIMPLE, ENGLISH)}
TABLES = ["posts", "stats", "segments", "staged"]


@dataclass
class Archive:
    """`indexes` names the configurations that are indexed."""

    spark: SparkSession
    folder: str
    indexes: tuple[str, ...] = ("simple",)
    buckets: int = 64
    commits: Commits = field(init=False)

    def __post_init__(self):
        self.commits = Commits(self.spark, self.folder)

    def _index(self, state: dict, name: str) -> TermIndex:
        return TermIndex(self.spark, self.folder, CONFIGS[name], [tuple(s) for s in state.get("indexes", {}).get(name, [])])

    def _parts(self, state: dict, table: str) -> DataFrame | None:
        paths = state.get(table, [])
        return self.spark.read.parquet(*paths) if paths else None

    def _kept(self, state: dict) -> set[str]:
        return {*state.get("posts", []), *state.get("stats", []), *(p for i in state.get("indexes", {}).values() for p, _ in i)}

    def sources(self) -> list[str]:
        """The sources that are stored, in the order in which they were."""
        return self.commits.latest()[1].get("sources", [])

    def store(self, config: Config = SIMPLE) -> PostStore | None:
        """The posts, summary and index of the last commit; None before the first."""
        _, state = self.commits.latest()
        posts = self._parts(state, "posts")
        if posts is None:
            return None
        index = self._index(state, config.name) if config.name in state["indexes"] else None
        return PostStore(posts, dedup.merge_stats(self._parts(state, "stats")), index)

    def sync(self, lock: Sequence[str], offers: Callable[[str], DataFrame]) -> list[str]:
        """Stores the sources of an ordered list that aren't stored yet, and returns their names. The stored ones must be the
        beginning of the list, for the first writer of a post wins: another order would be another store."""
        number, state = self.commits.latest()
        done = state.get("sources", [])
        if list(lock[: len(done)]) != done:
            raise ValueError(f"stored are {done}, which is no beginning of {list(lock)}")
        self.commits.sweep(TABLES, self._kept(state))
        for name in lock[len(done) :]:
            state = self._with_source(state, name, offers(name))
            self.commits.commit(state, number)
            number += 1
        return list(lock[len(done) :])

    def _with_source(self, state: dict, name: str, offers: DataFrame) -> dict:
        part, keys = len(state.get("sources", [])), KeyStore(self.spark, f"{self.folder}/keys", self.buckets)
        real = offers.filter(~filters.is_ghost(F.col("subnum"))).drop("subnum") if "subnum" in offers.columns else offers
        new = dedup.first_writer(real, tuple(c for c in ("source_rank",) if c in real.columns)).drop("source_rank")
        new = self._write(keys.absent(new, F.col("part") < part), "posts")
        keys.put(self.spark.read.parquet(new), part)
        self._written("keys")
        posts = self.spark.read.parquet(new)
        stats = self._write(aggregates.post_stats(posts), "stats")
        out = {"sources": [*state.get("sources", []), name], "posts": [*state.get("posts", []), new], "stats": [*state.get("stats", []), stats], "indexes": {}}
        simple = None
        for config in sorted(self.indexes, key=lambda c: c != SIMPLE.name):
            index = self._index(state, config)
            if not index.segments and state.get("posts"):  # an index that is new, or was dropped
                added = index.added(self.spark.read.parquet(*out["posts"]))
            elif config == ENGLISH.name and simple is not None:  # texts are not read again, nor a term stemmed twice
                added = index.with_postings(stemmed_index(simple))
            else:
                added = index.added(posts)
                simple = self.spark.read.parquet(added.segments[-1][0]) if config == SIMPLE.name else simple
            out["indexes"][config] = added.merged().segments
            self._written("segments")
        return out

    def _write(self, rows: DataFrame, table: str) -> str:
        path = self.commits.new_part(table)
        rows.write.parquet(path)
        self._written(table)
        return path

    def _written(self, what: str) -> None:
        """Called after each write, for those who watch a run."""

    def build_indexes(self, only: str | None = None) -> None:
        """Builds the indexes anew, or one alone."""
        number, state = self.commits.latest()
        posts = self._parts(state, "posts")
        new = {n: TermIndex(self.spark, self.folder, CONFIGS[n], []).added(posts).segments for n in ([only] if only else self.indexes)}
        self.commits.commit(state | {"indexes": state["indexes"] | new}, number)

    def drop_indexes(self, only: str | None = None) -> None:
        """Forgets the indexes, or one alone; searches read texts again, and the next source builds them anew."""
        number, state = self.commits.latest()
        self.commits.commit(state | {"indexes": {n: s for n, s in state["indexes"].items() if only and n != only}}, number)

    def index_status(self) -> DataFrame:
        """(name, segment, postings, files, bytes, terms) of the indexes."""
        _, state = self.commits.latest()
        out = None
        for name in state.get("indexes", {}):
            one = self._index(state, name).status().select(F.lit(name).alias("name"), "segment", "postings", "files", "bytes", "terms")
            out = one if out is None else out.unionByName(one)
        return out if out is not None else self.spark.createDataFrame([], "name string, segment string, postings long, files long, bytes long, terms long")
