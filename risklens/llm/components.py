"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from risklens.llm.shared import written


def _least_neighbour(edges: DataFrame, key: str) -> DataFrame:
    return edges.groupBy(key).agg(F.min("to").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour (or itself)."""
    both = edges.select("at", "to").unionByName(edges.select(F.col("to").alias("at"), F.col("at").alias("to")))
    least = _least_neighbour(both, "at").withColumn("least", F.least("at", "least"))
    return both.join(least, "at").where("to > at").select(F.col("to").alias("at"), F.col("least").alias("to"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("at", "to").alias("at"), F.least("at", "to").alias("to"))
    least = _least_neighbour(down, "at")
    linked = down.join(least, "at").where("to != least").select(F.col("to").alias("at"), F.col("least").alias("to"))
    return linked.unionByName(least.select("at", F.col("least").alias("to")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node with an edge; the label is the component's least node."""
    edges = written(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("at"), F.least(a, b).alias("to")).distinct())
    seen = None
    while True:
        edges = written(_small_star(_large_star(edges)).distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("at", "to").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    labels = edges.select(F.col("at").alias("node"), F.col("to").alias("label"))
    roots = edges.select(F.col("to").alias("node"), F.col("to").alias("label")).distinct()
    return written(labels.unionByName(roots))
