"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written


def components(edges: DataFrame, name: str) -> DataFrame:
    """(v, label): for every vertex of edges (a, b) the least vertex that it is connected with.

    Labels go to the neighbours, and then each vertex takes the label of its label, so a path of n vertices takes about
    log n rounds. Each round is written and the one before it deleted. Hubs are pre-aggregated before the shuffle, and
    Spark splits skewed joins.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = written(both, f"{name}-edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("v"), F.least("a", "low").alias("label")), f"{name}-labels")
    while True:
        lower = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("low"))
        near = labels.join(lower, labels["v"] == lower["a"]).select("v", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        near = written(near, f"{name}-near")
        of = near.select(F.col("v").alias("label"), F.col("label").alias("far"))
        jumped = written(near.join(of, "label", "left").select("v", "old", F.least("label", "far").alias("label")), f"{name}-labels")
        discard(labels, near)
        labels = jumped
        if labels.filter(F.col("old") != F.col("label")).isEmpty():
            discard(both)
            return labels.select("v", "label")
