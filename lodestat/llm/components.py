"""Connected components of a large graph, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestat.session import scratch_tables, settle_outside, settle_table


def _nearest(links: DataFrame) -> DataFrame:
    """``(u, m)``: the smallest of each node and its neighbours, pre-aggregated before the shuffle."""
    return links.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller one, or only links to larger ones."""
    ends = links.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                         F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges (a, b)``: the smallest node that it reaches.

    Large-star steps tie a node's larger neighbours to its smallest one, small-star
    steps its smaller ones; both keep the components, and the links end as stars. Each
    round is kept on reliable storage; a node with many neighbours is only ever
    aggregated or joined, never gathered.
    """
    with scratch_tables(edges.sparkSession):
        links = settle_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
        while True:
            both = links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
            # Repeated links are left to the small step, since each link makes one of them at most.
            large = both.join(_nearest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            small = large.join(_nearest(large), "u").select(
                F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
            links = settle_table(small.filter("u <> v").distinct())
            if _stars(links):
                break
        links = settle_outside(links)
    return (links.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct())
