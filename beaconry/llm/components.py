"""Connected components of an edge table by alternating star contractions.

Each round joins edges with the smallest neighbour of their end. A node that
owns a third of all edges is summed per task before the shuffle (``min``) and
its edge rows meet it in a plain equi-join, which adaptive execution may split.
Rounds are checkpointed to the shared folder; nothing but two sums per round
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.session import shared_root


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them (u > v holds)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node with an edge; root: smallest node reachable.

    ``edges`` has two long columns, the ends. Self loops and nulls are ignored,
    repeated edges count once, an empty table gives an empty result. Roots are
    their own root.
    """
    shared_root(edges.sparkSession)
    a, b = edges.columns
    now = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
           .filter("u > v").distinct().checkpoint())
    seen = _state(now)
    while seen[0]:
        now = _small_star(_large_star(now)).checkpoint()
        got = _state(now)
        if got == seen:
            break
        seen = got
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
