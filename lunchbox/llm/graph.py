"""Connected components of an edge table by contraction, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lunchbox.llm.runtime import freed, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b); label: a node common to its component.

    Each round points a node at its least neighbour, jumps twice along those
    pointers, and carries on with the edges between different ends; a round
    at least halves what is left.  Every round ends in a written table, so a
    lost executor repeats one round at most.  Nothing reaches the driver but
    the count of edges left.
    """
    labels, given = None, True
    while True:
        both = edges.select("a", "b").where("a <> b").union(edges.selectExpr("b", "a").where("a <> b"))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to"))
        least = step = written(step, "step")
        for _ in range(2):
            far = step.select(F.col("node").alias("to"), F.col("to").alias("beyond"))
            step = step.join(far, "to").select("node", F.col("beyond").alias("to"))
        step = written(step, "jump")
        freed(least)
        if labels is None:
            labels = step.select("node", F.col("to").alias("label"))
            labels.llm_path = step.llm_path
        else:
            nxt = step.select(F.col("node").alias("label"), "to")
            old, labels = labels, written(labels.join(nxt, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
            freed(old)
        ends = edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a").join(
            step.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
        old, edges = edges, written(ends.where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges")
        if not given:
            freed(old)
        if labels.llm_path != step.llm_path:
            freed(step)
        given = False
        if edges.isEmpty():
            freed(edges)
            return labels
