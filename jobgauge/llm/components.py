"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge.sources.scratch import written


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and root, the smallest node reachable, for every node in a link to another one.

    Alternates two steps until nothing changes: every larger neighbour is linked to the smallest neighbour of a node,
    then every node and its smaller neighbours to the smallest of them. Each round is an aggregate and a join of the
    links, written out; only their number and checksum reach the driver.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = written(edges.distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple[int, int]:
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), F.coalesce(checksum, F.lit(0))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    own = least.select("u", F.col("m").alias("v"))
    return joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct()
