"""Connected components by alternating star contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import dropped, stored


def connected_components(links: DataFrame, a: str = "src", b: str = "dst") -> DataFrame:
    """(a, b) undirected links -> node, root: each linked node with the smallest node of its component.

    Each round hangs the larger neighbours of every node under the smallest one (large star) and then the smaller ones
    (small star); rounds needed grow with the logarithm of the longest path. Each round is written to the shared
    folder, so that plans stay short and lost executors cost one round at most. Null ends and loops say nothing; nodes
    without links are not returned. An empty table gives no rows.
    """
    edges = links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    edges, before = stored(edges, "links"), None  # u > v always
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        after_edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "links")
        after = after_edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        dropped(edges)
        edges = after_edges
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
