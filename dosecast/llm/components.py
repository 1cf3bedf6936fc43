"""Connected components of an edge table, by alternating large-star and small-star steps in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosecast.sources.staging import stage

MAX_ROUNDS = 50


def components(edges: DataFrame) -> DataFrame:
    """node and component (its least node) of all nodes of the columns ``a`` and ``b``; self-loops are ignored.

    Each round joins every edge to the least neighbour of its ends; minima combine before they are shuffled, and the join may be
    split where a node is an end of very many edges. Rounds are written to the shared folder. The edges end as stars.
    """
    now = stage(_down(edges.select("a", "b")), "edges")
    sign = None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(_down(large), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least.hint("merge"), "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        now = stage(_down(small), "edges")
        found = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(found) == sign:
            break
        sign = tuple(found)
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _down(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return (
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
