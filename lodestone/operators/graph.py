"""Walks over a directed graph of edges (src, dst, edge_type, weight), as joins level by level.

Each level is written to the shared folder, so that plans don't grow with the hops and lost executors cost one level.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .ontology import STRUCTURAL
from .temporal import holds


def degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count("*").alias("degree"))


def hot_edges(edges: DataFrame, nodes: DataFrame, types: tuple[str, ...], degree_cap: int = 5000, day: str | None = None) -> DataFrame:
    """Edges on a day between nodes of the hot types, structural ones and those out of supernodes left out."""
    rows = edges.where(~F.col("edge_type").isin(*STRUCTURAL) & (F.col("src") != F.col("dst")))
    rows = rows.where(holds(day)) if day else rows
    warm = nodes.where(F.col("node_type").isin(*types)).select("node_id")
    rows = rows.join(warm.withColumnRenamed("node_id", "src"), "src", "left_semi").join(warm.withColumnRenamed("node_id", "dst"), "dst", "left_semi")
    rows = stored(rows, "hot")  # needed twice: for the degrees and for the edges
    return rows.join(degrees(rows).where(F.col("degree") > degree_cap).select("src"), "src", "left_anti")


def reached(out_of: Callable[[DataFrame], DataFrame], seeds: DataFrame, hops: int) -> DataFrame:
    """The edges that walks of up to ``hops`` from seeds (node_id) can take. out_of(ids) gives the edges out of some nodes (node_id); no node is asked for twice."""
    asked = frontier = stored(seeds.select("node_id").distinct(), "asked")
    found = []
    for hop in range(hops):
        found.append(stored(out_of(frontier), "reached"))
        if hop < hops - 1:
            ahead = found[-1].select(F.col("dst").alias("node_id")).distinct()
            frontier = stored(ahead.join(asked, "node_id", "left_anti"), "asked")
            if frontier.isEmpty():
                break
            asked = asked.unionByName(frontier)
    return reduce(DataFrame.unionByName, found)


def closure(edges: DataFrame, max_hops: int = 3, seeds: DataFrame | None = None, types: bool = False) -> DataFrame:
    """src, dst, hops, weight (product), path (array) of the best simple path of each pair: fewest hops, then most weight, then first path.

    A best path's beginning is itself a best path, so each level keeps one path a pair and only pairs not met before go on.
    With seeds (node_id), only pairs that start there are made, from the first level on. With types there is also
    edge_types (array): all types of the edges between neighbours on the path, sorted.
    """
    said = [F.array_sort(F.collect_set("edge_type")).alias("edge_types")] if types else []
    step = edges.groupBy("src", "dst").agg(F.max("weight").alias("w"), *said).where("src != dst")
    step = stored(step, "step")
    kinds = ["edge_types"] if types else []
    first = step if seeds is None else step.join(seeds.select(F.col("node_id").alias("src")).distinct(), "src", "left_semi")
    level = first.select("src", "dst", F.lit(1).alias("hops"), F.col("w").alias("weight"), F.array("src", "dst").alias("path"), *kinds)
    level = level if seeds is None else stored(level, "closure")
    levels = [level]
    onward = step.select(F.col("src").alias("via"), F.col("dst").alias("to"), "w", *[F.col(c).alias(f"next_{c}") for c in kinds])
    for hop in range(2, max_hops + 1):
        longer = level.join(onward, level["dst"] == onward["via"]).where(~F.array_contains("path", F.col("to")))
        more = [F.array_sort(F.array_union(c, f"next_{c}")).alias(c) for c in kinds]
        best = longer.groupBy("src", "to").agg(F.min(F.struct((-F.col("weight") * F.col("w")).alias("least"), F.concat("path", F.array("to")).alias("path"), *more)).alias("b"))
        best = best.select("src", F.col("to").alias("dst"), F.lit(hop).alias("hops"), (-F.col("b.least")).alias("weight"), F.col("b.path").alias("path"), *[f"b.{c}" for c in kinds])
        level = stored(best.join(reduce(DataFrame.unionByName, levels).select("src", "dst"), ["src", "dst"], "left_anti"), "closure")
        levels.append(level)
    return reduce(DataFrame.unionByName, levels)


def expand(closed: DataFrame, seeds: DataFrame, nodes: DataFrame, hops: int = 2, tier: int = 0, limit: int = 200) -> DataFrame:
    """Out of a closure: what seeds (node_id) reach within hops, no node of a path above the tier."""
    rows = closed.where(F.col("hops") <= hops).join(seeds.select(F.col("node_id").alias("src")), "src", "left_semi")
    rows = rows.join(nodes.where(F.col("masking_tier") <= tier).select(F.col("node_id").alias("dst")), "dst", "left_semi")
    hidden = rows.select("src", "dst", F.explode("path").alias("node_id")).join(nodes.where(F.col("masking_tier") > tier).select("node_id"), "node_id", "left_semi").select("src", "dst")
    return rows.join(hidden, ["src", "dst"], "left_anti").orderBy("hops", F.desc("weight"), "src", "dst").limit(limit)


def expand_snapshot(closures: DataFrame, seeds: DataFrame, nodes: DataFrame, hops: int = 2, day: str | None = None, types: list[str] | None = None, tier: int = 0, limit: int = 200) -> DataFrame:
    """expand() over stored closures (as_of, src, dst, hops, weight, path, edge_types), of one day or else the latest; with types, only paths with an edge of one of them."""
    # one row, whatever the closures hold; the day then prunes partitions
    at = day or closures.agg(F.max("as_of").cast("string")).first()[0]
    rows = closures.where(F.col("as_of") == F.lit(at).cast("date"))
    rows = rows.where(F.arrays_overlap("edge_types", F.array(*[F.lit(t) for t in types]))) if types else rows
    return expand(rows, seeds, nodes, hops, tier, limit)


def traverse(edges: DataFrame, seeds: DataFrame, nodes: DataFrame, max_hops: int = 4, tier: int = 3, types: list[str] | None = None, limit: int | None = 500, product: bool = False) -> DataFrame:
    """All simple paths out of seeds: seed, node, hops, total_weight (sum or product), path; nodes above the tier are never entered.

    With a limit: the first so many by hops, then most weight, then path. No level of more rows is written.
    """
    seen = nodes.where(F.col("masking_tier") <= tier).select(F.col("node_id").alias("to"))
    step = edges.where(F.col("edge_type").isin(types)) if types else edges
    step = stored(step.select(F.col("src").alias("via"), F.col("dst").alias("to"), F.coalesce("weight", F.lit(1.0)).alias("weight")).join(seen, "to", "left_semi"), "step")
    total = F.col("total_weight") * F.col("weight") if product else F.col("total_weight") + F.col("weight")
    start = seeds.select("node_id").join(seen, F.col("node_id") == F.col("to"), "left_semi")
    level = start.select(F.col("node_id").alias("seed"), F.col("node_id").alias("node"), F.lit(0).alias("hops"), F.lit(1.0 if product else 0.0).alias("total_weight"), F.array("node_id").alias("path"))
    found, order = None, ("hops", F.desc("total_weight"), F.array_join("path", ">"))
    for _ in range(max_hops):
        level = level.join(step, level["node"] == step["via"]).where(~F.array_contains("path", F.col("to")))
        level = level.select("seed", F.col("to").alias("node"), (F.col("hops") + 1).alias("hops"), total.alias("total_weight"), F.concat("path", F.array("to")).alias("path"))
        # a level that has as many is the last one, so no more of it is needed
        level = stored(level.orderBy(*order).limit(limit) if limit else level, "walk")
        found = level if found is None else found.unionByName(level)
        if limit and found.count() >= limit:
            break  # longer paths come after all of these
    found = found if found is not None else level.where(F.lit(False))
    return found.orderBy(*order).limit(limit) if limit else found


def both_ways(edges: DataFrame) -> DataFrame:
    """Each edge and its reverse, as often as the edge is there: walks group what they reach, and no task holds the ends of all its edges to tell them apart."""
    rows = edges.select("src", "dst").where("src != dst")
    return rows.select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("e")).select("e.src", "e.dst")


def levels(edges: DataFrame, seeds: DataFrame, hops: int, directed: bool = False, among: DataFrame | None = None) -> DataFrame:
    """node_id, level: how many edges lead from the nearest seed (level 0); frontier by frontier, visited nodes never again. ``among`` (node_id): no other node is entered."""
    step = edges.select("src", "dst") if directed else both_ways(edges)
    step = stored(step if among is None else step.join(among.select(F.col("node_id").alias("dst")), "dst", "left_semi"), "step")
    visited = stored(seeds.select("node_id", F.lit(0).alias("level")).distinct(), "visited")
    frontier = visited
    for level in range(1, hops + 1):
        ahead = frontier.join(step, frontier["node_id"] == step["src"]).select(F.col("dst").alias("node_id")).distinct()
        frontier = stored(ahead.join(visited.select("node_id"), "node_id", "left_anti").withColumn("level", F.lit(level)), "frontier")
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


def shortest_paths(edges: DataFrame, pairs: DataFrame, nodes: DataFrame, max_hops: int = 6, tier: int = 3, directed: bool = True) -> DataFrame:
    """pair, hops, path (array) of the shortest path of each of the pairs (pair, a, b; one row a pair), all at once; of equals the first in the order of the ids.

    Two frontiers, from the one end and from the other, go on until they meet; each time the smaller one does. Of each node
    they keep the first path: one that is a part of the first path as a whole. A pair whose ends have met is done. Depth is
    bounded, hidden nodes are no way through; pairs without a path, or with a null or hidden end, have no row. Edges are
    written as they are: whether a node is there and not hidden is asked of those that are reached, not of all ends.
    """
    seen = stored(nodes.where(F.col("masking_tier") <= tier).select("node_id"), "seen")
    step, found = stored(edges.select("src", "dst") if directed else both_ways(edges), "step"), []

    def entered(rows: DataFrame) -> DataFrame:
        rows = stored(rows, "ahead")
        there = seen.join(rows.select(F.col("node").alias("node_id")), "node_id", "left_semi")  # the few go to the nodes
        return stored(rows.join(there, F.col("node") == F.col("node_id"), "left_semi"), "frontier")

    sides = [entered(pairs.select("pair", F.col(c).alias("node"), F.array(c).alias("path"))) for c in ("a", "b")]
    visited, sizes = list(sides), [s.count() for s in sides]
    for hops in range(max_hops + 1):
        rest = sides[1].select("pair", "node", F.col("path").alias("rest"))
        met = sides[0].join(rest, ["pair", "node"]).select("pair", F.concat("path", F.slice("rest", 2, F.size("rest"))).alias("path"))
        met = stored(met.groupBy("pair").agg(F.min("path").alias("path")), "met")
        found.append(met)
        if not met.isEmpty():
            sides = [s.join(met.select("pair"), "pair", "left_anti") for s in sides]
            sizes = [s.count() for s in sides]
        if hops == max_hops or not all(sizes):
            break
        i = int(sizes[1] < sizes[0])  # 0: on from a, along the edges; 1: on from b, against them
        here, there = ("src", "dst") if i == 0 else ("dst", "src")
        longer = F.concat("path", F.array(there)) if i == 0 else F.concat(F.array(there), F.col("path"))
        ahead = sides[i].join(step, F.col("node") == F.col(here)).groupBy("pair", F.col(there).alias("node")).agg(F.min(longer).alias("path"))
        sides[i] = entered(ahead.join(visited[i].select("pair", "node"), ["pair", "node"], "left_anti"))
        visited[i] = visited[i].unionByName(sides[i])
        sizes[i] = sides[i].count()
    return reduce(DataFrame.unionByName, found).select("pair", (F.size("path") - 1).alias("hops"), "path")


def shortest_path(edges: DataFrame, a: str, b: str, nodes: DataFrame, max_hops: int = 6, tier: int = 3, directed: bool = True) -> DataFrame:
    """hops, path of the shortest path from a to b, as shortest_paths() finds it."""
    one = edges.sparkSession.range(1).select(F.col("id").alias("pair"), F.lit(a).alias("a"), F.lit(b).alias("b"))
    return shortest_paths(edges, one, nodes, max_hops, tier, directed).select("hops", F.array_join("path", ">").alias("path"))


def neighbours(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with either end among ids (node_id): two semi joins, no edge twice."""
    out = edges.join(ids.select(F.col("node_id").alias("src")), "src", "left_semi")
    into = edges.join(ids.select(F.col("node_id").alias("dst")), "dst", "left_semi").join(ids.select(F.col("node_id").alias("src")), "src", "left_anti")
    return out.unionByName(into)


def neighbourhood(edges: DataFrame, nodes: DataFrame, ids: DataFrame, types: tuple[str, ...] | None = None, day: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(edges with either end among ids (node_id), of some types and in force on a day, if given; the nodes at both their ends, whatever their days)."""
    rows = edges.where(F.col("edge_type").isin(*types)) if types else edges
    rows = neighbours(rows.where(holds(day)) if day else rows, ids)
    ends = rows.select(F.explode(F.array("src", "dst")).alias("node_id")).distinct()
    return rows, nodes.join(ends, "node_id", "left_semi")


def induced(edges: DataFrame, ids: DataFrame) -> DataFrame:
    return edges.join(ids.select(F.col("node_id").alias("src")), "src", "left_semi").join(ids.select(F.col("node_id").alias("dst")), "dst", "left_semi")


def pagerank(edges: DataFrame, rounds: int = 20, damping: float = 0.85) -> DataFrame:
    """Weighted, undirected: node_id, rank after a fixed number of rounds; rank sums to one."""
    pairs = edges.select("src", "dst", "weight").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")).where("src != dst")
    pairs = pairs.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    share = pairs.join(pairs.groupBy("src").agg(F.sum("weight").alias("total")), "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))
    share = stored(share, "share")
    n = share.select("src").distinct().count()
    ranks = share.select(F.col("src").alias("node_id")).distinct().withColumn("rank", F.lit(1.0 / n if n else 0.0))
    for i in range(rounds):
        sent = ranks.join(share, ranks["node_id"] == share["src"]).groupBy("dst").agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
        ranks = sent.select(F.col("dst").alias("node_id"), ((1 - damping) / n + damping * F.col("got")).alias("rank"))
        if i % 5 == 4:
            ranks = stored(ranks, "ranks")
    return ranks
