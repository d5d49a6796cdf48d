"""Connected components on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that a link (a, b) names; root is the
    smallest node that can be reached.

    Alternating large-star and small-star rounds: every node's neighbours are
    hung on its smallest neighbour until only stars are left.  A round is two
    aggregations with map-side combine and two equi-joins (a hub's rows can be
    split by AQE), written to the shared checkpoint folder, so the plan does
    not grow and a lost executor repeats at most one round."""
    def state(df: DataFrame) -> tuple:
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where(F.col("u") != F.col("v")).distinct(), "links")
    before = None
    while (now := state(edges))[0] and now != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = hung.where(F.col("u") != F.col("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).distinct()
        edges, before = written(small, "small-star"), now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
