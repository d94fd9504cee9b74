"""Connected components of a table of links, as DataFrames from start to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node that each linked node can reach.

    Large-star and small-star steps in turn until nothing changes; their number grows with the
    logarithm of the longest chain. Each step's edges are written to the shared folder. A node with
    many links costs a row a link, and its least neighbour is found by partial aggregation.

    Defined results: links with a null end and links of a node to itself are left out, and so is a node
    without other links. Repeated links and both directions count as one. An empty table gives an empty
    result. Only the two columns are read.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v AND u IS NOT NULL AND v IS NOT NULL").distinct(), "links"
    )
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        before, edges = edges, stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "links"
        )
        discard(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
