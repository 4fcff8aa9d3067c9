"""Spectral measures of components that are too large for one task: a vector is a table of one number a node, a product with a matrix is a join.

All large components are worked on together. What a component needs as a whole (sums of products, one row a component) is
broadcast: there are at most as many rows as the nodes divided by the size from which a component counts as large.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import dropped, stored
from .joins import heavy_keys, spread_join

#: Two lengths are one if they differ by no more than this.
SAME = 1e-12
#: exp(-FAR) is nothing beside the rounding of numbers about 1.
FAR = 50.0


def both_directions(rows: DataFrame) -> DataFrame:
    """component, src, dst, weight of each edge and its reverse, stored."""
    back = rows.select("component", F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return stored(rows.select("component", "src", "dst", "weight").unionByName(back), "both")


def _dot(vector: Column, factors: Column) -> Column:
    """The sum of products of two arrays, as far as the second one goes."""
    return F.aggregate(F.zip_with(F.slice(vector, F.lit(1), F.size(factors)), factors, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)


def _times(step: DataFrame, heavy: DataFrame, rows: DataFrame, x: Column) -> DataFrame:
    """rows (component, node, ...) with w, the product of the matrix step (src, dst, a) and x, stored."""
    sent = spread_join(step.select("src", "dst", "a"), rows.select(F.col("node").alias("src"), x.alias("x")), "src", heavy)
    got = sent.groupBy(F.col("dst").alias("node")).agg(F.sum(F.col("a") * F.col("x")).alias("w"))
    return stored(rows.join(got, "node", "left").fillna(0.0, ["w"]), "product")


def _add_direction(rows: DataFrame, size: int) -> DataFrame:
    """rows (component, node, q (array of size orthonormal numbers), w) -> w made orthogonal to q, twice, and appended to it; sums and norm a component beside it."""
    sums = F.array(*[F.sum(F.col("q")[i] * F.col("w")) for i in range(size)])
    first = rows.join(F.broadcast(rows.groupBy("component").agg(sums.alias("c1"))), "component").withColumn("w", F.col("w") - _dot(F.col("q"), F.col("c1")))
    second = first.join(F.broadcast(first.groupBy("component").agg(sums.alias("c2"))), "component").withColumn("w", F.col("w") - _dot(F.col("q"), F.col("c2")))
    norms = second.groupBy("component").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    out = second.join(F.broadcast(norms), "component")
    unit = F.when(F.col("norm") > SAME, F.col("w") / F.col("norm")).otherwise(0.0)
    return stored(out.select("component", "node", F.array_append("q", unit).alias("q"), F.zip_with("c1", "c2", lambda a, b: a + b).alias("c"), "norm"), "directions")


def fiedler(edges: DataFrame, width: int = 40, kept: int = 8, rounds: int = 50, exact: float = 1e-10) -> DataFrame:
    """component, node_id, spectral_gap, fiedler_coord of edges (component, src, dst, weight; each pair once, each component connected).

    Lanczos steps with full reorthogonalisation on the normalised adjacency matrix; its known first eigenvector is the first
    direction and thereby taken out. After ``width`` directions the ``kept`` best Ritz vectors and the last direction start
    the next round. A component is done when its residual is below ``exact``, or no new direction is left; ArithmeticError
    if one isn't after all rounds. The first coordinate (by node) that is not zero is positive.
    """
    both = both_directions(edges)
    degree = both.groupBy("component", F.col("src").alias("node")).agg(F.sum("weight").alias("d"))
    whole = degree.groupBy("component").agg(F.sum("d").alias("total"))
    nodes = stored(degree.join(F.broadcast(whole), "component").select("component", "node", "d", F.sqrt(F.col("d") / F.col("total")).alias("root")), "nodes")
    end = lambda c: nodes.select(F.col("node").alias(c), F.col("d").alias(f"d_{c}"))
    heavy = stored(heavy_keys(both, "src"), "heavy")
    step = spread_join(spread_join(both, end("src"), "src", heavy), end("dst"), "dst", heavy.withColumnRenamed("src", "dst"))
    step = stored(step.select("src", "dst", (F.col("weight") / F.sqrt(F.col("d_src") * F.col("d_dst"))).alias("a")), "matrix")
    # numbers that look random and are the same in every run
    start = nodes.select("component", "node", F.array("root").alias("q"), (F.pmod(F.xxhash64("node"), F.lit(1_000_003)) / 1_000_003.0 - 0.5).alias("w"))
    rows = _add_direction(start, 1)
    size, h, spent, found = 2, {}, {}, {}
    for turn in range(rounds):
        while size <= width:
            old, product = rows, _times(step, heavy, rows.select("component", "node", "q"), F.col("q")[size - 1])
            rows = _add_direction(product, size)
            for r in rows.groupBy("component").agg(F.first("c").alias("c"), F.first("norm").alias("norm")).collect():  # one row a large component
                if r["component"] in spent:
                    continue
                m = h.setdefault(r["component"], np.zeros((width + 1, width + 1)))
                m[: size, size - 1] = m[size - 1, : size] = r["c"]
                m[size, size - 1] = m[size - 1, size] = r["norm"]
                values, vectors = np.linalg.eigh(m[1:size, 1:size])
                found[r["component"]] = (values, vectors, size)
                if abs(r["norm"] * vectors[-1, -1]) <= exact or r["norm"] <= SAME:
                    spent[r["component"]] = True
            size += 1
            dropped(old)
            dropped(product)
            if len(spent) == len(h):
                break
        if len(spent) == len(h):
            break
        if turn + 1 == rounds:
            raise ArithmeticError(f"{len(h) - len(spent)} components without an eigenvector after {rounds} rounds")
        # thick restart: the best Ritz vectors, then the direction that was to come next
        parts, old = [], rows
        for c, (values, vectors, n) in found.items():
            best = vectors[:, ::-1][:, :kept].T
            best = np.vstack([best, np.zeros((kept - len(best), n - 1))])  # of spent components there may be fewer
            parts.append((c, [[0.0] + v.tolist() + [0.0] * (width - n + 1) for v in best]))
            if c not in spent:
                h[c] = np.zeros((width + 1, width + 1))
                h[c][range(1, kept + 1), range(1, kept + 1)] = values[::-1][:kept]
        parts = edges.sparkSession.createDataFrame(parts, f"component {edges.schema['component'].dataType.simpleString()}, mix array<array<double>>")
        mixed = F.concat(F.array(F.col("q")[0]), F.transform("mix", lambda m: _dot(F.col("q"), m)), F.array(F.col("q")[size - 1]))
        rows = stored(rows.join(F.broadcast(parts), "component").select("component", "node", mixed.alias("q")), "directions")
        dropped(old)
        for c in spent:  # their answer is now a plain Ritz vector: the first one
            found[c] = (np.array([found[c][0][-1]]), np.ones((1, 1)), 2)
        size = kept + 2
    answers = [(c, float(1 - values[-1]), [0.0] + vectors[:, -1].tolist()) for c, (values, vectors, _) in found.items()]
    answers = edges.sparkSession.createDataFrame(answers, f"component {edges.schema['component'].dataType.simpleString()}, spectral_gap double, mix array<double>")
    v = rows.join(F.broadcast(answers), "component").select("component", "node", "spectral_gap", _dot(F.col("q"), F.col("mix")).alias("v"))
    v = stored(v, "ritz")
    scale = v.groupBy("component").agg((F.sqrt(F.sum(F.col("v") * F.col("v"))) * F.signum(F.min_by("v", F.when(F.abs("v") > 1e-9, F.col("node"))))).alias("scale"))
    return v.join(F.broadcast(scale), "component").select("component", F.col("node").alias("node_id"), "spectral_gap", (F.col("v") / F.col("scale")).alias("fiedler_coord"))


def shortest(step: DataFrame, sources: DataFrame, farthest: float | None = None) -> DataFrame:
    """component, source, node, d: lengths of the shortest paths from each source (component, source) along step (src, dst, weight; positive), none above ``farthest``.

    All sources at once: in each round only pairs whose length has become shorter go on.
    """
    heavy = stored(heavy_keys(step, "src"), "heavy")
    links = step.where("weight > 0").select("src", "dst", "weight")
    best = frontier = stored(sources.select("component", "source", F.col("source").alias("node"), F.lit(0.0).alias("d")), "lengths")
    while True:
        # up to a thousand heavy nodes: their rows of the frontier (one a source) are broadcast, their edges stay in place
        ahead = spread_join(links, frontier.withColumnRenamed("node", "src"), "src", heavy).select("component", "source", F.col("dst").alias("node"), (F.col("d") + F.col("weight")).alias("d"))
        ahead = ahead.where(F.col("d") <= farthest) if farthest is not None else ahead
        ahead = ahead.groupBy("component", "source", "node").agg(F.min("d").alias("d"))
        known = best.select("source", "node", F.col("d").alias("known"))
        shorter = ahead.join(known, ["source", "node"], "left").where(F.col("known").isNull() | (F.col("d") < F.col("known") - SAME))
        frontier = stored(shorter.select("component", "source", "node", "d"), "frontier")
        if frontier.isEmpty():
            return best
        old, best = best, stored(best.join(frontier.select("source", "node"), ["source", "node"], "left_anti").unionByName(frontier), "lengths")
        dropped(old)


def _waves(first: DataFrame, links: DataFrame) -> DataFrame:
    """source, node, x: what first (source, node, x) and all its waves along links (source, node, to, f) add up to; links hold no cycle, so waves end."""
    waves = [stored(first.select("source", "node", "x"), "wave")]
    while not waves[-1].isEmpty():
        sent = waves[-1].join(links, ["source", "node"]).groupBy("source", F.col("to").alias("node")).agg(F.sum(F.col("x") * F.col("f")).alias("x"))
        waves.append(stored(sent, "wave"))
    return stored(reduce(DataFrame.unionByName, waves).groupBy("source", "node").agg(F.sum("x").alias("x")), "waves")


def betweenness(edges: DataFrame, pivots: int = 200) -> DataFrame:
    """component, node_id, betweenness of edges (component, src, dst, weight as a length, positive; each pair once), normalised for undirected graphs.

    From all nodes, or, of a component with more than ``pivots``, from those with the least hashes, scaled up. How many
    shortest paths lead to a node is the sum over their hops, and so is what lies behind a node, backwards: both are waves.
    """
    both = both_directions(edges)
    nodes = stored(both.select("component", F.col("src").alias("node")).distinct(), "nodes")
    ranked = nodes.withColumn("at", F.row_number().over(W.partitionBy("component").orderBy(F.xxhash64("node"), "node")))
    sources = stored(ranked.where(F.col("at") <= pivots).select("component", F.col("node").alias("source")), "sources")
    d = shortest(both, sources)
    heavy = stored(heavy_keys(both, "src"), "heavy")
    ends = spread_join(both.where("weight > 0").select("src", "dst", "weight"), d.select("source", F.col("node").alias("src"), "d"), "src", heavy)
    to = d.select("source", F.col("node").alias("dst"), F.col("d").alias("d_dst"))
    ways = ends.join(to, ["source", "dst"]).where(F.abs(F.col("d") + F.col("weight") - F.col("d_dst")) <= SAME)
    ways = stored(ways.select("source", F.col("src").alias("a"), F.col("dst").alias("b")), "ways")
    start = sources.select("source", F.col("source").alias("node"), F.lit(1.0).alias("x"))
    paths = _waves(start, ways.select("source", F.col("a").alias("node"), F.col("b").alias("to"), F.lit(1.0).alias("f")))
    part = lambda c: paths.select("source", F.col("node").alias(c), F.col("x").alias(f"n_{c}"))
    share = ways.join(part("a"), ["source", "a"]).join(part("b"), ["source", "b"])
    share = stored(share.select("source", F.col("b").alias("node"), F.col("a").alias("to"), (F.col("n_a") / F.col("n_b")).alias("f")), "shares")
    behind = _waves(d.select("source", "node", F.lit(1.0).alias("x")), share)  # 1 for the node itself
    total = behind.where("source != node").groupBy("node").agg(F.sum(F.col("x") - 1).alias("x"))
    sizes = nodes.groupBy("component").agg(F.count("*").alias("n")).join(sources.groupBy("component").agg(F.count("*").alias("k")), "component")
    n, k = F.col("n"), F.col("k")
    scale = F.when(n > 2, (n / k) / ((n - 1) * (n - 2))).otherwise(0.0)
    return nodes.join(total, "node", "left").join(F.broadcast(sizes), "component").select("component", F.col("node").alias("node_id"), (F.coalesce("x", F.lit(0.0)) * scale).alias("betweenness"))


def magnitude(edges: DataFrame, t: float = 1.0, rounds: int = 1000, exact: float = 1e-12) -> DataFrame:
    """component, node_id, magnitude: the solution of Z w = 1 with Z = exp(-t d) over the pairs that are no farther apart than FAR / t.

    Conjugate residuals; components whose system isn't solved after all rounds have zeros, as those of a singular matrix.
    """
    both = both_directions(edges)
    nodes = stored(both.select("component", F.col("src").alias("node")).distinct(), "nodes")
    z = shortest(both, nodes.withColumnRenamed("node", "source"), FAR / t)
    z = stored(z.select(F.col("source").alias("src"), F.col("node").alias("dst"), F.exp(-t * F.col("d")).alias("a")), "near")
    heavy = stored(heavy_keys(z, "src"), "heavy")
    state = nodes.withColumns({"x": F.lit(0.0), "r": F.lit(1.0), "p": F.lit(1.0)})
    state = _times(z, heavy, state, F.col("r")).withColumnRenamed("w", "zr").withColumn("zp", F.col("zr"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)  # noqa: E731  a solved component stands still
    for _ in range(rounds):
        sums = state.groupBy("component").agg(F.sum(F.col("r") * F.col("zr")).alias("bend"), F.sum(F.col("zp") * F.col("zp")).alias("zpzp"))
        moved = state.join(F.broadcast(sums), "component")
        step = ratio(F.col("bend"), F.col("zpzp"))
        moved = moved.select("component", "node", (F.col("x") + step * F.col("p")).alias("x"), (F.col("r") - step * F.col("zp")).alias("r"), "p", "zp", F.col("bend").alias("before"))
        new = _times(z, heavy, moved, F.col("r")).withColumnRenamed("w", "zr")
        after = new.groupBy("component").agg(F.sum(F.col("r") * F.col("zr")).alias("after"), (F.sqrt(F.avg(F.col("r") * F.col("r"))) <= exact).alias("solved"))
        bent = new.join(F.broadcast(after), "component").withColumn("turn", ratio(F.col("after"), F.col("before")))
        old = state
        state = stored(bent.select("component", "node", "x", "r", (F.col("r") + F.col("turn") * F.col("p")).alias("p"), "zr", (F.col("zr") + F.col("turn") * F.col("zp")).alias("zp"), "solved"), "residuals")
        dropped(new)
        dropped(old)
        if state.where("NOT solved").isEmpty():
            break
    return state.select("component", F.col("node").alias("node_id"), F.when(F.col("solved"), F.col("x")).otherwise(0.0).alias("magnitude"))
