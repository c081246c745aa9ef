"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwatch.session import settled


def label(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from each node of ``edges`` (columns ``a``, ``b``; integers).

    Every round, a node takes the smallest label among its neighbours and itself, then the label
    of that label, so a chain of length n needs about log n rounds. Both steps are joins and
    minimums that combine before the shuffle; the labels are written to the shared folder after
    each round, and rounds go on until no label changes. Nulls and loops are left out; an empty
    table gives no rows.

    Columns: ``node``, ``component``.
    """
    proper = edges.select("a", "b").filter("a <> b")
    both = settled(proper.union(proper.select("b", "a")).distinct(), "edges")
    labels = settled(
        both.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("node"), F.least("a", "low").alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy("a")
            .agg(F.min("component").alias("low"))
        )
        lower = labels.join(near, labels.node == near.a).select(
            "node", F.col("component").alias("was"), F.least("component", "low").alias("low")
        )
        jump = labels.select(F.col("node").alias("of"), F.col("component").alias("jumped"))
        new = settled(
            lower.join(jump, lower.low == jump.of, "left").select(
                "node", "was", F.least("low", F.coalesce("jumped", "low")).alias("component")
            ),
            "labels",
        )
        labels = new.select("node", "component")
        if new.filter("component <> was").isEmpty():
            return labels
