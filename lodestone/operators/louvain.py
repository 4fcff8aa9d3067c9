"""Hierarchical communities of large graphs: label moves as joins, quotient graphs by level.

A pass starts with every node in a community of its own. In each round a half of the nodes (another half each time, by a
hash) look at the communities of their neighbours, weights summed by node and community before anything else, and move to
the one that raises modularity most; as the others stay where they are, nodes don't run after each other or change places
for ever. The best labels of all rounds count; then communities become the nodes of a smaller graph, and passes follow until
modularity stands still; a last pass moves single nodes between the communities found. No task ever holds a component: all
there is are joins of edges with one label a node.

Modularity is that of each connected component, as weights count against its own total.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import dropped, stored
from ..sources.sinks import replace_partitions
from .components import connected_components
from .joins import heavy_keys, spread_join

#: Rise of modularity that counts as one, and rounds in a row without one after which a pass ends.
LEAST_RISE, PATIENCE = 1e-6, 2


def undirected(edges: DataFrame) -> DataFrame:
    """src, dst, weight in both directions: parallel edges summed, loops and edges without weight left out."""
    rows = edges.select("src", "dst", "weight").where("src != dst AND weight > 0")
    both = rows.unionByName(rows.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    return both.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def _nodes(links: DataFrame, components: DataFrame) -> DataFrame:
    """node, component, k (its weight), loop (the part of it that is its own), total (of the component)."""
    k = links.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("k"), F.sum(F.when(F.col("src") == F.col("dst"), F.col("weight")).otherwise(0.0)).alias("loop"))
    k = k.join(components, "node")
    totals = k.groupBy("component").agg(F.sum("k").alias("total"))
    return spread_join(k, totals, "component", heavy_keys(k, "component"))


def _round(ties_of: DataFrame, labels: DataFrame, heavy: DataFrame | None, resolution: float, number: int) -> DataFrame:
    """labels (node, label, k, loop, total) after one round, with old (label) and inside (weight to nodes of the old label)."""
    weights = labels.groupBy("label").agg(F.sum("k").alias("t"))
    said = labels.select(F.col("node").alias("dst"), "label")
    ties = ties_of.join(said, "dst") if heavy is None else spread_join(ties_of, said, "dst", heavy)
    ties = ties.groupBy("src", "label").agg(F.sum("weight").alias("tie"))
    at = labels.join(weights.withColumnRenamed("t", "own_t"), "label").select(F.col("node").alias("src"), F.col("label").alias("own"), "k", "loop", "total", "own_t")
    near = ties.join(weights, "label").join(at, "src", "right")
    is_own = F.coalesce(F.col("label") == F.col("own"), F.lit(False))
    near = near.withColumns({"is_own": is_own, "gain": F.col("tie") - resolution * F.col("k") * F.col("t") / F.col("total")})
    best = near.groupBy("src", "own", "k", "loop", "total", "own_t").agg(
        F.coalesce(F.max(F.when(F.col("is_own"), F.col("tie"))), F.lit(0.0)).alias("inside"), F.min(F.when(~F.col("is_own"), F.struct((-F.col("gain")).alias("less"), "label"))).alias("b")
    )
    stay = F.col("inside") - resolution * F.col("k") * (F.col("own_t") - F.col("k")) / F.col("total")
    turn = F.pmod(F.xxhash64("src", F.lit(number)), F.lit(2)) == 0
    moves = F.coalesce(turn & (-F.col("b.less") > stay + 1e-12 * F.col("total")), F.lit(False))
    return best.select(F.col("src").alias("node"), F.when(moves, F.col("b.label")).otherwise(F.col("own")).alias("label"), "k", "loop", "total", F.col("own").alias("old"), "inside")


def _score(after: DataFrame, resolution: float) -> float:
    """Modularity of the labels before the round, each component by its weight."""
    each = after.groupBy("old", "total").agg(F.sum("k").alias("t"), F.sum(F.col("inside") + F.col("loop")).alias("i"))
    q, weight = each.agg(F.sum(F.col("i") - resolution * F.col("t") * F.col("t") / F.col("total")), F.sum("t")).first()
    return q / weight if weight else 0.0


def _pass(links: DataFrame, nodes: DataFrame, resolution: float, start: DataFrame | None = None) -> tuple[DataFrame, float, float]:
    """(node, label: the smallest node of its community; modularity at first and at last) of one pass of moves, from ``start`` (node, label) or single nodes."""
    ties_of = links.where("src != dst")
    crowds = stored(heavy_keys(ties_of.select("dst"), "dst"), "heavy")
    heavy = None if crowds.isEmpty() else crowds
    now = nodes.withColumn("label", F.col("node")) if start is None else nodes.join(start, "node")
    best = now = stored(now.select("node", "label", "k", "loop", "total"), "labels")
    first, most, idle, number = None, -float("inf"), 0, 0
    while idle < PATIENCE:
        after = stored(_round(ties_of, now.select("node", "label", "k", "loop", "total"), heavy, resolution, number), "labels")
        q = _score(after, resolution)  # of ``now``
        first = q if first is None else first
        old, idle = (best, 0) if q > most + LEAST_RISE else (now, idle + 1)
        if not idle:
            best, most = now, q
        if old is not best:
            dropped(old)
        now, number = after, number + 1
    names = best.groupBy("label").agg(F.min("node").alias("name"))
    named = stored(best.select("node", "label").join(names, "label").select("node", F.col("name").alias("label")), "named")
    for table in {id(t): t for t in (best, now)}.values():
        dropped(table)
    return named, first, most


def quotient(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The graph of communities: weights between and within them, in both directions."""
    one = links.join(labels.select(F.col("node").alias("src"), F.col("label").alias("a")), "src").join(labels.select(F.col("node").alias("dst"), F.col("label").alias("b")), "dst")
    return stored(one.groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("weight").alias("weight")), "quotient")


def settle(links: DataFrame, components: DataFrame, resolution: float) -> DataFrame:
    """node, label (the smallest node of its community): passes over smaller and smaller graphs until modularity rises no more, and one over single nodes."""
    nodes = stored(_nodes(links, components), "nodes")
    held, inner, parts, level = None, links, components, nodes
    while True:
        labels, first, last = _pass(inner, level, resolution)
        risen = last > first + LEAST_RISE
        if held is None:
            held = labels
        elif risen:
            held = stored(held.join(labels.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").select("node", F.col("next").alias("label")), "held")
        if not risen:
            break
        inner = quotient(inner, labels)
        parts = parts.join(labels.select("node").where("node = label"), "node", "left_semi")
        level = stored(_nodes(inner, parts), "nodes")
    return _pass(links, nodes, resolution, held)[0]


def community_labels(edges: DataFrame, levels: int = 3, run_id: str = "") -> DataFrame:
    """node_id, level, community_id, parent_id (the community one level up; null at the last): every node of an edge with a weight above zero.

    Level l joins the communities of the level before with resolution 1 / (l + 1); a component with fewer than two of
    them has no further level. An id is made of the first eight letters of the run, the level and the smallest member, so
    communities never share one. Loops, null weights and weights of zero or less say nothing; parallel edges add up.
    """
    links = stored(undirected(edges), "links")
    parts = stored(connected_components(links).select("node", F.col("root").alias("component")), "parts")
    out, inner, own, chain = [], links, parts, None
    for level in range(levels):
        labels = settle(inner, own, 1.0 / (level + 1))
        chain = labels if chain is None else stored(chain.join(labels.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").select("node", F.col("next").alias("label")), "chain")
        out.append(chain)
        left = own.join(labels.where("node = label").select("node"), "node", "left_semi")
        several = left.groupBy("component").agg(F.count("*").alias("n")).where("n >= 2").select("component")
        own = stored(left.join(several, "component", "left_semi").select("node", "component"), "parts")
        if own.isEmpty():
            break
        inner = stored(quotient(inner, labels).join(own.select(F.col("node").alias("src")), "src", "left_semi"), "inner")
    prefix = f"{run_id[:8]}_" if run_id else ""
    name = lambda level: F.concat(F.lit(f"{prefix}L{level}_"), "label").alias("community_id")
    rows = []
    for level, labels in enumerate(out):
        one = labels.select(F.col("node").alias("node_id"), F.lit(level).alias("level"), name(level))
        above = out[level + 1].select(F.col("node").alias("node_id"), name(level + 1).alias("parent_id")) if level + 1 < len(out) else None
        rows.append(one.withColumn("parent_id", F.lit(None).cast("string")) if above is None else one.join(above, "node_id", "left"))
    return reduce(DataFrame.unionByName, rows)


def keep_run(labels: DataFrame, path: str, run_id: str, min_size: int = 3) -> None:
    """Stores a run's membership: run_id, level, community_id, parent_id, member_count, node_id, a row a member; communities of fewer than ``min_size`` members are left out. Runs lie beside each other, and one that comes again replaces itself."""
    sizes = labels.groupBy("community_id").agg(F.count("*").alias("member_count")).where(F.col("member_count") >= min_size)
    rows = spread_join(labels, sizes, "community_id", heavy_keys(labels, "community_id"))
    replace_partitions(rows.select("level", "community_id", "parent_id", "member_count", "node_id", F.lit(run_id).alias("run_id")), path, "run_id")


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Of labels (node_id, community_id) over the whole graph."""
    links = undirected(edges)
    one = links.join(labels.select(F.col("node_id").alias("src"), F.col("community_id").alias("a")), "src").join(labels.select(F.col("node_id").alias("dst"), F.col("community_id").alias("b")), "dst")
    each = one.groupBy("a").agg(F.sum("weight").alias("t"), F.sum(F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0.0)).alias("i"))
    inside, squares, total = each.agg(F.sum("i"), F.sum(F.col("t") * F.col("t")), F.sum("t")).first()
    return inside / total - resolution * squares / total**2 if total else 0.0
