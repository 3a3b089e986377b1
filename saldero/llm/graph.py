"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import staged


def _low(edges: DataFrame) -> DataFrame:
    # stored, so that adaptive execution may split the rows of a node with many links
    return staged(edges.groupBy("u").agg(F.min("v").alias("low")), "lows")


def components(links: DataFrame) -> DataFrame:
    """(u, v) with ``v`` the smallest node that ``u`` reaches, for every other node.

    ``links`` has the columns u and v in either order. Alternating large and
    small stars: the neighbours of a node are linked to the smallest of them,
    first the larger ones, then the smaller ones, until nothing changes.
    """
    order = [F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")]
    edges = staged(links.where("u <> v").select(*order).distinct(), "edges")
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = edges.agg(*mark).first()
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _low(both).select("u", F.least("u", "low").alias("low"))
        larger = both.join(low, "u").where("v > u")
        large = staged(larger.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "large")
        low = _low(large)
        smaller = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        stars = smaller.where("u <> v").union(low.select("u", F.col("low").alias("v")))
        edges = staged(stars.distinct(), "edges")
        after = edges.agg(*mark).first()
        if after == before:
            return edges
        before = after
