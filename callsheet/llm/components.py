"""Connected components by alternating star contraction on DataFrames.

Every round rewrites the edges towards the smallest neighbour and is written to the
shared folder, so a lost executor costs at most one round. Rounds grow with the
logarithm of the component size. Nothing is collected but one number a round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callsheet.functions.stages import stored


def _stars(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Point the neighbours of each node (or the node and its smaller ones) to the smallest."""
    low = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = pairs.join(low, "u")
    if larger_only:
        return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    near = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.unionByName(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (root: the smallest node reachable) of every node with an edge.

    ``edges`` has two columns of one ordered type, read as undirected; loops, repeats and
    either direction are fine, null ends are ignored. No edges: an empty result."""
    a, b = edges.columns
    u, v = F.greatest(a, b), F.least(a, b)
    now = stored(edges.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, larger_only=True).distinct()
        now = stored(_stars(large.filter("u > v"), larger_only=False).filter("u > v").distinct(), "edges")
        # The edge set is settled when neither its size nor its content sum moves.
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
