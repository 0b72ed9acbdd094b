"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coclick.llm.store import materialise


def min_labels(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(a, b)``; label is the smallest node of its component.

    Each step sends every node to its smallest neighbour (or itself) and
    replaces the ends of the edges by those; at least half of a component's
    nodes vanish per step, the smallest node never does.  Each step is two
    joins and a map-side combined aggregate; tables are written between steps.
    """
    edges = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "component-edges")
    label = None
    while True:
        parent = materialise(
            edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("near")),
                                           F.struct(F.col("b").alias("node"), F.col("a").alias("near")))).alias("e"))
            .groupBy("e.node").agg(F.min("e.near").alias("near"))
            .select("node", F.least("node", "near").alias("up")), "component-parents")
        if label is None:
            label = parent.select("node", F.col("up").alias("label"))
        else:
            label = materialise(
                label.join(parent.select(F.col("node").alias("label"), "up"), "label", "left")
                .select("node", F.coalesce("up", "label").alias("label")), "component-labels")
        edges = materialise(
            edges.join(parent.select(F.col("node").alias("a"), F.col("up").alias("x")), "a")
            .join(parent.select(F.col("node").alias("b"), F.col("up").alias("y")), "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "component-edges")
        if edges.isEmpty():
            return label
