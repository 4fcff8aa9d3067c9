"""Closures that follow their graph: only what starts near a changed edge is walked again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .graph import closure, levels


def _best(edges: DataFrame) -> DataFrame:
    """What a closure knows of edges: of each pair the largest weight, and all types."""
    return edges.where("src != dst").groupBy("src", "dst").agg(F.max("weight").alias("weight"), F.array_sort(F.collect_set("edge_type")).alias("types"))


def affected(old: DataFrame, new: DataFrame, max_hops: int) -> DataFrame:
    """node_id: where walks of max_hops edges start that may meet a changed edge, in the old graph or in the new one.

    These are the starts of edges that came, went or changed, and all nodes from which one of them can be reached in
    max_hops - 1 steps: a search against the edges' direction, each node met once.
    """
    a, b = _best(old), _best(new).select(F.col("src").alias("s"), F.col("dst").alias("d"), F.col("weight").alias("w"), F.col("types").alias("t"))
    both = stored(a.join(b, (F.col("src") == F.col("s")) & (F.col("dst") == F.col("d")), "full"), "both")
    changed = both.where(F.col("s").isNull() | F.col("src").isNull() | ~F.col("weight").eqNullSafe(F.col("w")) | ~F.col("types").eqNullSafe(F.col("t")))
    back = both.select(F.coalesce("dst", "d").alias("src"), F.coalesce("src", "s").alias("dst"))
    return levels(back, changed.select(F.coalesce("src", "s").alias("node_id")), max_hops - 1, directed=True).select("node_id")


def updated(before: DataFrame, old: DataFrame, new: DataFrame, max_hops: int = 3, types: bool = False) -> DataFrame:
    """The closure of the new edges, from that of the old ones: pairs that start at an affected node are made anew, all others stay.

    The same rows as graph.closure(new, max_hops, types=types). ``before`` may be null-free only where that is.
    """
    starts = stored(affected(old, new, max_hops), "affected")
    fresh = closure(new, max_hops, starts, types)
    return before.join(starts.withColumnRenamed("node_id", "src"), "src", "left_anti").select(fresh.columns).unionByName(fresh)


def delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """src, dst, hops, weight, path, change: the pairs whose best path or weight differ; a pair that went comes with what it was."""
    names = [c for c in after.columns if c not in ("src", "dst")]
    old = before.select(F.col("src").alias("s"), F.col("dst").alias("d"), F.struct(*[c for c in names]).alias("was"))
    both = old.join(after.select("src", "dst", F.struct(*names).alias("is")), (F.col("s") == F.col("src")) & (F.col("d") == F.col("dst")), "full")
    kind = F.when(F.col("was").isNull(), "insert").when(F.col("is").isNull(), "delete").when(~F.col("was").eqNullSafe(F.col("is")), "update")
    rows = both.select(F.coalesce("src", "s").alias("src"), F.coalesce("dst", "d").alias("dst"), F.coalesce("is", "was").alias("v"), kind.alias("change")).where("change IS NOT NULL")
    return rows.select("src", "dst", "v.*", "change")
