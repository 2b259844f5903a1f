"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the undirected edges ``(u, v)``; root is the smallest node reachable.

    Alternates "attach larger neighbours to the smallest" and "attach smaller
    neighbours to the smallest" until the edge set stands still (a logarithmic
    number of rounds in practice).  Every round is written to the shared
    folder.  Null ends and self loops are ignored; repeated edges and an empty
    table are fine (empty result).  Node type: anything Spark can order.
    """
    current = written(
        edges.select("u", "v").filter("u is not null and v is not null and u <> v").distinct(), "edges"
    )
    seen = None
    while True:
        current = written(_small_star(_large_star(current)), "stars")
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or state[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state
