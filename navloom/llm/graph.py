"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is one aggregate to the least neighbour and one join; the state is an
edge table that never grows, written to the shared checkpoint folder, so lost
executors cost one step at most.  The joined sides are both read from storage,
which lets adaptive execution split the hot centre of a large star.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import staged


def _attach(sides: DataFrame) -> DataFrame:
    """Join every (u, v) with the least of u and its neighbours."""
    least = staged(sides.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("k"), F.least("u", "m").alias("m")))
    return sides.join(least, F.col("u") == F.col("k")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = staged(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    return _attach(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    found = _attach(edges)
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        found.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node reachable, of every node in an edge.

    Direction, repeats and loops do not matter; rows with a null end are ignored.
    An empty edge table gives an empty result.
    """
    a, b = F.col(first).cast("long"), F.col(second).cast("long")
    state = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        a.isNotNull() & b.isNotNull() & (a != b)).distinct())
    mark = None
    while True:
        state = staged(_small_star(staged(_large_star(state))))
        # Every node points at its centre once nothing moves: compare order-free sums.
        row = state.agg(F.count(F.lit(1)), F.sum(F.expr("cast(xxhash64(u, v) as decimal(38,0))"))).first()
        if tuple(row) == mark:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = tuple(row)
