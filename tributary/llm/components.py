"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of type long).

    Alternating large-star and small-star steps: each node is pointed at the
    smallest neighbour until the edges are stars around the smallest node of
    each component.  Every step is an aggregate and a join, so nothing about a
    component is ever held in one place; each round is written to shared
    storage.  Self-loops and repeated edges are allowed; an empty edge list
    gives an empty result; nodes without an edge do not appear.
    """
    current = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "components")
    state = _digest(current)
    while state[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.join(nearest, "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(lowest.select("u", F.col("m").alias("v"))).distinct())
        current = stored(small, "components")
        after = _digest(current)
        if after == state:
            break
        state = after
    return (current.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(current.select(F.col("v"), F.col("v")).distinct()))
