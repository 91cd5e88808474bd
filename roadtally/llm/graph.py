"""Connected components of a link table, by spreading minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadtally.llm.common import deleted, written


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its smallest node.

    Each round takes the smallest label among the neighbours and then the label of that label, so the labelled
    distance doubles. Rounds are written tables: lineage stays short and lost executors cost one round. Joins read
    written tables on both sides, so that adaptive execution can split a hub's rows. Tables of earlier rounds are deleted;
    the result is a written table itself (``scratch_path``). No links give no rows.
    """
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        spread = written(
            labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")),
            "spread",
        )
        shortcut = spread.select(F.col("node").alias("label"), F.col("label").alias("far"))
        following = written(
            spread.join(shortcut, "label").select("node", "old", F.least("label", "far").alias("label")), "labels"
        )
        moved = following.where(F.col("label") != F.col("old")).limit(1).count()
        deleted(labels, spread)
        labels = following
        if not moved:
            deleted(both)
            out = labels.select("node", F.col("label").alias("component"))
            out.scratch_path = labels.scratch_path
            return out
