"""Connected components of an undirected graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnstar.sources.workdir import materialise


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; a component is its least node.

    Each round a node takes the least label among its neighbours and then the label of that
    node, so labels travel distances that double. Rounds are written, so a lost executor
    repeats tasks of one round. A node with very many neighbours sends one row per map task
    to the minimum, and its joins are between written tables, whose hot keys adaptive
    execution splits. Only "has any label changed" reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    loops = both.select("a", F.col("a").alias("b"))
    links = materialise(both.union(loops).distinct(), "links")
    labels = materialise(
        links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")), "labels"
    )
    while True:
        near = (
            links.join(labels, links["b"] == labels["node"])
            .groupBy("a")
            .agg(
                F.min("component").alias("least"),
                F.min(F.when(F.col("a") == F.col("b"), F.col("component"))).alias("own"),
            )
        )
        near = materialise(near, "near")
        if near.filter("least < own").isEmpty():
            return labels
        jump = near.select(F.col("a").alias("node"), F.col("least").alias("via"))
        reach = near.select(F.col("a").alias("via"), F.col("least").alias("component"))
        labels = materialise(jump.join(reach, "via").select("node", "component"), "labels")


def merge_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` after further ``edges`` between nodes: found on the components, not the nodes."""
    a, b = (
        labels.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))
        for x in ("a", "b")
    )
    between = edges.distinct().join(a, "a", "left").join(b, "b", "left")
    between = between.select(
        F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")
    ).distinct()
    merged = components(materialise(between, "between"))
    new = merged.select(F.col("node").alias("component"), F.col("component").alias("least"))
    known = labels.join(new, "component", "left").select(
        "node", F.coalesce("least", "component").alias("component")
    )
    unknown = merged.join(labels.select("node"), "node", "left_anti")
    return materialise(known.union(unknown), "labels")
