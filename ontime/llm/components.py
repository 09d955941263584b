"""Connected components by alternating large and small stars, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    found = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")
    ).first()
    return found["n"], found["h"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``, the root being the smallest node.

    Edges may repeat, point either way or loop; a null end is left out. Each round hangs every
    neighbourhood under its smallest member, first for the larger, then for the smaller neighbours,
    so the number of rounds grows with the logarithm of the longest path. A node with very many
    edges is only ever grouped by a partial minimum and joined by a key that adaptive execution
    may split. Rounds end when the edges stop changing; one that has not settled by then raises.
    """
    current = stage(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = _state(current)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stage(
            small.unionByName(lower.select("u", F.col("m").alias("v"))).where("u != v")
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
            "edges",
        )
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    # Settled edges are stars: every node but the roots points at its root.
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
