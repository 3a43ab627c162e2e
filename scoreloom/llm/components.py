"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.staging import stage


def _least(pairs: DataFrame) -> DataFrame:
    """Of each ``u`` the least of itself and its neighbours, as a staged table.

    Staging makes the join that follows one of two plain tables, so adaptive execution
    may split a hub with very many neighbours over several tasks.
    """
    return stage(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``; the root is the least node reachable.

    Every edge always points from the larger node to the smaller, and both stars keep the
    components. The rounds end when a round changes nothing: then every node points to
    its root. The number of rounds grows with the logarithm of the longest chain. The
    driver sees one count and one sum a round. Self-loops, repeats and nulls add nothing;
    an empty table gives an empty one.
    """
    now = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), "edges")
    state = _state(now)
    while state[0]:
        large = stage(_large_star(now).where("u <> v").distinct(), "large")
        now = stage(_small_star(large).where("u <> v").distinct(), "small")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
