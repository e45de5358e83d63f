"""Connected components of a large edge table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import keep as kept


def components(edges: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = kept) -> DataFrame:
    """`node, label` for every node of the edges `a, b`: the least node of its component.

    Labels sink along edges, and each then jumps to its label's label, so the number of
    rounds is about the logarithm of the longest path. Every round is a stored table;
    a hub's edges are combined before they are shuffled. `keep` stores a table.
    """
    both = keep(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(),
        "component-edges",
    )
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        sunk = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
            .join(labels, "node")
            .select("node", F.least("near", "label").alias("new"), F.col("label").alias("old"))
        )
        sunk = keep(sunk, "labels-sunk")
        above = sunk.select(F.col("node").alias("at"), F.col("new").alias("next"))
        jumped = keep(
            sunk.join(above, sunk["new"] == above["at"], "left").select("node", F.coalesce("next", "new").alias("label"), "old"),
            "labels",
        )
        labels = jumped.select("node", "label")
        if jumped.where("label <> old").isEmpty():
            return labels
