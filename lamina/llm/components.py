"""Connected components of a graph of links, as joined tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import pin


def connected(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``edges`` (``a, b``): the smallest node reachable from it.

    Every turn gives each node the smallest label around it and then that label's own, and draws the
    links anew between labels. Links inside a label vanish, so the links left shrink fast, and the
    turns grow with the logarithm of the longest path. Labels are combined before the shuffle, so a
    node with very many links costs no more than its links.
    """
    links = pin(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = pin(nodes.select("node", F.col("node").alias("label")), "labels")
    links = links.where("a <> b")
    while not links.isEmpty():
        near = (
            links.select(F.col("b").alias("node"), F.col("a").alias("label"))
            .groupBy("node")
            .agg(F.min("label").alias("label"))  # a is the smaller end
        )
        near = pin(near, "near")
        up = near.select(F.col("node").alias("label"), F.col("label").alias("higher"))
        step = pin(
            near.join(up, "label", "left").select("node", F.coalesce("higher", "label").alias("to")),
            "step",
        )
        labels = pin(
            labels.join(step.withColumnRenamed("node", "label"), "label", "left").select(
                "node", F.coalesce("to", "label").alias("label")
            ),
            "labels",
        )
        moved = lambda end: step.select(F.col("node").alias(end), F.col("to").alias(f"to_{end}"))  # noqa: E731,B023
        left, right = F.coalesce("to_a", "a"), F.coalesce("to_b", "b")
        links = pin(
            links.join(moved("a"), "a", "left")
            .join(moved("b"), "b", "left")
            .select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"))
            .where("a <> b")
            .distinct(),
            "links",
        )
    return labels
