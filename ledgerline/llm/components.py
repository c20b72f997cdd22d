"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def _jump(parent: DataFrame) -> DataFrame:
    """Each node's root: pointers double until none changes."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
        step = written(parent.join(up, "root", "left").select(
            "node", F.coalesce("above", "root").alias("root"),
            (F.coalesce("above", "root") != F.col("root")).alias("moved")), "jump")
        parent = step.select("node", "root")
        if step.where("moved").isEmpty():
            return parent


def components(links: DataFrame) -> DataFrame:
    """(node, root) of each node of ``links`` (a, b): root is the smallest
    node that it reaches.

    Every round hooks each node to its smallest neighbour, follows the
    pointers to the roots and keeps the links between different roots, of
    which at least half go each time.  A hub's links are combined before the
    shuffle; nothing is gathered on the driver but whether links are left."""
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .where("a <> b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = _jump(written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                               .select("node", F.least("node", "least").alias("root")), "hooks"))
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
            labels = written(labels.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "labels")
        left = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = written(edges.join(left, "a").join(right, "b").where("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
