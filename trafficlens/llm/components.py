"""Connected components by alternating large-star and small-star steps, each an aggregation and a join.

The aggregates are written before they are joined: both sides of a join are then plain
shuffles, of which adaptive execution can divide the side of a hub's many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "components_least")
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "components_least")
    joined = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    moved = joined.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node of each connected component, for nodes that have a link.

    ``links`` has bigint columns u and v. Every round writes its edges, so no
    round recomputes an earlier one; a round's edges never outnumber the links.
    """
    oriented = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = written(oriented.distinct(), "components")
    before, now = None, _state(edges)
    while now != before and now[0]:
        edges = written(_small_star(_large_star(edges)), "components")
        before, now = now, _state(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
