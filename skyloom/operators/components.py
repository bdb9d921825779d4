"""Connected components of a table of edges, by stars: each round is two joins, and the rounds are about the logarithm
of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import discard, staged


def _least(sides: DataFrame) -> DataFrame:
    return sides.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's greater neighbours are tied to the least of its neighbourhood."""
    sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    tied = sides.join(_least(sides), "u").where("v > u")
    return tied.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours are tied to the least of these."""
    tied = edges.join(_least(edges), "u")
    out = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(tied.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``edges``, staged: the component is its least node. Ids are longs. Nodes tied
    to themselves only are their own component; an empty table gives no rows."""
    pairs = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
    pairs = staged(pairs.distinct(), "edges")  # what gives them is read once
    now = pairs.where("u <> v")
    alone = pairs.where("u = v").select(F.col("u").alias("node"), F.col("v").alias("component"))
    marks = lambda t: tuple(t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 999_983)).first())
    seen, rounds = marks(now), [pairs]
    while seen[0]:
        now = staged(_small_star(_large_star(now)), "edges")
        discard(*rounds[1:])
        rounds, before, seen = [pairs, now], seen, marks(now)
        if seen == before:
            break
    out = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    tops = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    alone = alone.distinct().join(out.unionByName(tops).select("node"), "node", "left_anti")
    found = staged(out.unionByName(tops).unionByName(alone), "components")
    discard(*rounds)
    return found
