"""Connected components of an edge table, on the cluster.

Alternating large-star and small-star steps: every node points its larger
neighbours, then its smaller ones and itself, at its smallest neighbour. The
edge table stays at most as long as it was, a node with very many edges is
pre-aggregated (min) and joined (which adaptive execution can split), and the
number of rounds grows with the logarithm of a component's size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise

MAX_ROUNDS = 60


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node_, component) for every node with an edge to another one; the
    component is its smallest node. Nodes are longs; nulls are ignored."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e = materialise(e, "edges")
    last = None
    for _ in range(MAX_ROUNDS):
        # large star: u > v everywhere, so the minimum around x counts both directions
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("k"), F.least("x", "m").alias("m"))
        large = e.join(least, F.col("v") == F.col("k")).select("u", F.col("m").alias("v")).where("u > v").distinct()
        # small star: u and its smaller neighbours go to the smallest of these
        lower = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        joined = large.join(lower, F.col("u") == F.col("k"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionAll(lower.select(F.col("k").alias("u"), F.col("m").alias("v")))
        e = materialise(small.distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("u").alias("node_"), F.col("v").alias("component"))
    return stars.unionAll(e.select(F.col("v").alias("node_"), F.col("v").alias("component")).distinct())
