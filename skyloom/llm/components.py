"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``id, component`` (smallest id reachable) of every id in ``edges(a, b)`` that is not itself a component's smallest.

    Each step sends an id at most one row per edge, so a hub is a hot join key (which AQE splits) and never a list.
    Repeated edges, both directions and loops are allowed. The number of steps grows with the logarithm of the ids.
    The answer is a staged table; those of the steps before it are deleted.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e, before = staged(e, "edges"), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Dealt anew, so that both sides of the join are plain exchanges and AQE can split a hub's rows.
        large = both.join(least.repartition("u"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.repartition("u"), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        last, e = e, staged(small.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")
        discard(last)
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            labels = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            labels._staged = e._staged
            return labels
        before = now
