"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltdrift.llm.common import passing, written


def _roots(pointers: DataFrame) -> DataFrame:
    """(node, parent) with every chain of parents followed to its end.

    Parents are never larger than their nodes, so a chain ends at a node that is
    its own parent; each step doubles the length of chain followed.
    """
    while True:
        above = pointers.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        pointers = written(
            pointers.join(above, "parent").select("node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved"))
        )
        moved = not pointers.where("moved").isEmpty()
        pointers = pointers.select("node", "parent")
        if not moved:
            return pointers


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (columns a, b); label: the smallest node it reaches.

    Each round points every node at its smallest neighbour (a minimum, combined
    before the shuffle), follows the pointers to their roots, and replaces the
    ends of the edges by them. At least half of the nodes that still have edges
    go in a round. A node with many edges is only ever on the many side of a
    join, where AQE splits it. Loops and edges with a NULL end are left out.
    """
    with passing() as made:
        return made.keep(_contracted(edges))


def _contracted(edges: DataFrame) -> DataFrame:
    edges = written(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        pointers = _roots(written(pointers.select("node", F.least("node", "parent").alias("parent"))))
        if labels is None:
            labels = pointers.withColumnRenamed("parent", "label")
        else:
            above = pointers.select(F.col("node").alias("label"), F.col("parent").alias("above"))
            labels = labels.join(above, "label", "left").select("node", F.coalesce("above", "label").alias("label"))
        labels = written(labels)
        to_a = pointers.select(F.col("node").alias("a"), F.col("parent").alias("root_a"))
        to_b = pointers.select(F.col("node").alias("b"), F.col("parent").alias("root_b"))
        moved = edges.join(to_a, "a").join(to_b, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        edges = written(
            moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        )
    if labels is None:
        labels = written(edges.select(F.col("a").alias("node"), F.col("a").alias("label")))
    return labels
