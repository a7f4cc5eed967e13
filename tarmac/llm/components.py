"""Connected components: each node gets the smallest node it reaches.

Every round, components joined by an edge hook onto their smallest neighbour and the chains are shortened
by doubling. Only local minima stay, at most half of the components that still have an edge, so the
rounds grow with the logarithm of the input. Everything stays in tables; each step is an aggregation with
partial sums or an equi-join of tables that were written, whose skewed keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.session import stored


def _relabelled(labels: DataFrame, parents: DataFrame) -> DataFrame:
    up = parents.select(F.col("node").alias("label"), F.col("parent").alias("root"))
    return labels.join(up, "label", "left").select("node", F.coalesce("root", "label").alias("label"))


def _roots(parents: DataFrame) -> DataFrame:
    """Parents replaced by the last parent of their chain."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = parents.join(up, "parent", "left").select(
            "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
        )
        jumped = stored(jumped, "parents")
        if jumped.filter("moved").isEmpty():
            return parents
        parents = jumped.drop("moved")


def merge_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels (node, label) after adding edges (a, b); each label is the smallest node of its component."""
    while True:
        ends = edges.join(labels.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
        ends = ends.join(labels.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
        between = ends.filter("x <> y").select(F.greatest("x", "y").alias("node"), F.least("x", "y").alias("parent"))
        parents = stored(between.groupBy("node").agg(F.min("parent").alias("parent")), "hooks")
        if parents.isEmpty():
            return labels
        labels = stored(_relabelled(labels, _roots(parents)), "labels")
