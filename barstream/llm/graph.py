"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Every node points to its smallest neighbour or itself; edges are then drawn between what their ends point to,
    so the edge table shrinks from round to round. A node with very many edges is combined before the shuffle.
    Each round is stored, so a lost executor repeats one round at most. Rows with a null end are no edges.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), "b").unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("b")))
        points = stored(ends.groupBy("node").agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to")), "points")
        if labels is None:
            labels = points.withColumnRenamed("to", "component")
        else:
            step = points.select(F.col("node").alias("component"), "to")
            labels = stored(labels.join(step, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")), "labels")
        for end in ("a", "b"):
            edges = edges.join(points.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("to", end)
        edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
