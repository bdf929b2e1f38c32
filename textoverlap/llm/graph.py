"""Connected components over a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textoverlap.llm.common import materialize


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node with an edge; root is the smallest node of its component.

    Alternating large-star and small-star rounds on (larger, smaller) edges until nothing changes: the number
    of rounds grows with the logarithm of the largest component. Each round is two aggregations (combined
    before the shuffle) and two equi-joins that adaptive execution may split, and is written to the shared
    folder, so neither a hub nor the lineage gathers in one task. Self edges are ignored; no edges give no rows.
    """
    pair = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    e = materialize(pair, "edges")
    before = _state(e)
    while before["n"]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "large_star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("u", "m")).where("a <> b").distinct()
        e = materialize(small, "small_star")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
