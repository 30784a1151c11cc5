"""Connected components of an edge table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import cut, drop_cut


def connected_components(edges: DataFrame, nodes: DataFrame, by: list[str]) -> DataFrame:
    """(by, node, component): the smallest node reachable over ``edges`` (by, u, v).

    Each round turns every edge towards the smallest neighbour (first of the larger ends, then of the smaller ones),
    so the graph shrinks to stars in few rounds whatever its diameter. Minima are added up map-side, and each round is
    written and read back.
    """
    current = cut(
        edges.filter("u <> v")
        .select(*by, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    while not _only_stars(current, by):
        both = current.unionByName(current.select(*by, F.col("v").alias("u"), F.col("u").alias("v")))
        # Written out, so that both join sides are plain exchanges and adaptive execution can split a hub's edges.
        first_lowest = cut(both.groupBy(*by, "u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")))
        large = (
            both.join(first_lowest, [*by, "u"])
            .filter("v > u AND v <> m")
            .select(*by, F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = cut(large)
        lowest = cut(large.groupBy(*by, "u").agg(F.min("v").alias("m")))
        linked = (
            large.join(lowest, [*by, "u"]).filter("v <> m").select(*by, F.col("v").alias("u"), F.col("m").alias("v"))
        )
        before = current
        current = cut(linked.unionByName(lowest.select(*by, "u", F.col("m").alias("v"))).distinct())
        drop_cut(before, first_lowest, large, lowest)
    found = current.select(*by, F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.join(found, [*by, "node"], "left").withColumn("component", F.coalesce("component", "node"))


def _only_stars(edges: DataFrame, by: list[str]) -> bool:
    """Every larger end has one smaller end, which is nobody's larger end."""
    ends = edges.groupBy(*by, "u").agg(F.count(F.lit(1)).alias("n"))
    if not ends.filter("n > 1").isEmpty():
        return False
    return edges.join(ends.select(*by, F.col("u").alias("v")), [*by, "v"], "left_semi").isEmpty()
