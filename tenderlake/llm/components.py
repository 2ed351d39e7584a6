"""Connected components of a table of links, by alternating star steps.

Every round is a few shuffles over the links; the links, never whole components, pass through
tasks. Each round is written to the shared folder, so that lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.operators.joins import splittable
from tenderlake.storage import materialize


def _state(links: DataFrame) -> tuple:
    """Enough to see whether a round changed the links."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _reshuffled(lookup: DataFrame, key: str) -> DataFrame:
    """The grouped lookup, ready for a join whose hot keys Spark may split (see `splittable`)."""
    if dict(lookup.dtypes)[key] == "binary":
        return lookup.withColumn(key, F.concat(key, F.lit(b"")))
    return splittable(lookup, [key])


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    least = _reshuffled(least.select("w", F.least("w", "m").alias("m")), "w")
    moved = both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("w"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them; in `links`, u is larger than v."""
    least = _reshuffled(links.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "w")
    moved = links.join(least, F.col("u") == F.col("w"))
    pairs = moved.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("p"))
    return pairs.select(F.col("p.u").alias("u"), F.col("p.m").alias("v")).where("u <> v").distinct()


def components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node reachable."""
    a, b = F.col(u), F.col(v)
    pairs = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    pairs = materialize(pairs, "links")
    before = _state(pairs)
    while before[0]:
        pairs = materialize(_small_star(_large_star(pairs)), "stars")
        after = _state(pairs)
        if after == before:
            break
        before = after
    leaves = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
