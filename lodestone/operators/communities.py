"""Spectral measures, one connected component at a time.

A component of up to LARGE nodes is worked on whole, by one task in numpy; larger ones are worked on by joins (spectra).
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from . import spectra
from .components import connected_components

#: Nodes up to which a component is one task's work.
LARGE = 50_000
#: Edges that a task of small components has on average: components are dealt out by their work, not by their few bytes.
TASK_EDGES = 2_000
#: Nodes up to which matrices are dense; neighbours from which the rest of an elimination is done by a dense matrix.
DENSE, CROWDED = 2_000, 60
#: exp(-FAR) is nothing beside the rounding of numbers about 1, even as a sum over many nodes.
FAR = 50.0


def _graph(pdf: pd.DataFrame) -> tuple[list, dict[tuple[int, int], float]]:
    names = sorted(set(pdf["src"]) | set(pdf["dst"]))
    number = {x: i for i, x in enumerate(names)}
    links: dict[tuple[int, int], float] = {}
    for s, d, w in sorted(zip(pdf["src"], pdf["dst"], pdf["weight"], strict=True)):
        a, b = sorted((number[s], number[d]))
        if a != b:
            links[a, b] = links.get((a, b), 0.0) + float(w)
    return names, links


def by_component(edges: DataFrame) -> DataFrame:
    """src, dst, weight (parallel edges summed, undirected), component, nodes (its size)."""
    one = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"), "weight").where("src != dst").groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    roots = connected_components(one)
    sizes = roots.groupBy("root").agg(F.count("*").alias("nodes"))
    return one.join(roots.select(F.col("node").alias("src"), F.col("root").alias("component")), "src").join(sizes.withColumnRenamed("root", "component"), "component")


def fiedler(n: int, links: dict[tuple[int, int], float]) -> tuple[float, np.ndarray]:
    """(second smallest eigenvalue, its vector) of the normalised Laplacian; the vector's first number that is not zero is positive."""
    value, v = _fiedler_dense(n, links) if n <= DENSE or min(links.values()) <= 0 else _fiedler_sparse(n, links)
    big = np.flatnonzero(np.abs(v) > 1e-9)
    return value, v * (np.sign(v[big[0]]) if len(big) else 1.0)


def _fiedler_dense(n: int, links: dict[tuple[int, int], float]) -> tuple[float, np.ndarray]:
    a = np.zeros((n, n))
    for (i, j), w in links.items():
        a[i, j] = a[j, i] = w
    d = 1 / np.sqrt(np.maximum(a.sum(1), 1e-12))
    values, vectors = np.linalg.eigh(np.eye(n) - d[:, None] * a * d)
    return float(values[1]), vectors[:, 1]


class Laplacian:
    """Solves L x = b for the Laplacian of a connected graph and any b that adds up to zero.

    The node of fewest neighbours is taken out, which joins its neighbours with each other (all terms are positive, so
    nothing cancels); once all have more than CROWDED neighbours, the rest is solved as a dense matrix.
    """

    def __init__(self, n: int, links: dict[tuple[int, int], float]) -> None:
        near: list[dict[int, float]] = [{} for _ in range(n)]
        for (a, b), w in links.items():
            near[a][b] = near[b][a] = w
        heap, self.out = [(len(x), i) for i, x in enumerate(near)], []
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            size, v = heapq.heappop(heap)
            if gone[v] or size != len(near[v]):
                continue
            if size > CROWDED or len(self.out) == n - 1:
                break
            ties = list(near[v].items())
            total, gone[v] = sum(w for _, w in ties), True
            self.out.append((v, np.array([a for a, _ in ties]), np.array([w / total for _, w in ties]), total))
            for k, (a, w) in enumerate(ties):
                del near[a][v]
                for b, u in ties[:k]:
                    near[a][b] = near[b][a] = near[a].get(b, 0.0) + w * u / total
            for a, _ in ties:
                heapq.heappush(heap, (len(near[a]), a))
        self.core = [v for v in range(n) if not gone[v]]
        at, m = {v: i for i, v in enumerate(self.core)}, len(self.core) - 1
        full = np.zeros((m + 1, m + 1))
        for v in self.core:
            for a, w in near[v].items():
                full[at[v], at[a]] = -w
            full[at[v], at[v]] = sum(near[v].values())
        self.inverse = np.linalg.inv(full[:m, :m])  # the last node is held at zero

    def solve(self, b: np.ndarray) -> np.ndarray:
        b, x = b.copy(), np.zeros(len(b))
        for v, near, share, _ in self.out:
            b[near] += share * b[v]
        x[self.core[:-1]] = self.inverse @ b[self.core[:-1]]
        for v, near, share, total in reversed(self.out):
            x[v] = b[v] / total + share @ x[near]
        return x


def _fiedler_sparse(n: int, links: dict[tuple[int, int], float], most: int = 300) -> tuple[float, np.ndarray]:
    """As _fiedler_dense for a connected graph, by Lanczos steps on the inverse, until the eigenvector stands to nine digits."""
    laplacian = Laplacian(n, links)
    i, j, w = np.array([k[0] for k in links]), np.array([k[1] for k in links]), np.array(list(links.values()))
    root = np.sqrt(np.bincount(i, w, n) + np.bincount(j, w, n))
    null = root / np.linalg.norm(root)
    basis, images = [], []
    q = np.random.default_rng(7).standard_normal(n)
    for step in range(min(most, n - 1)):
        for _ in range(2):
            q = q - null * (null @ q)
            for u in basis:
                q = q - u * (u @ q)
        size = np.linalg.norm(q)
        if step and size < 1e-13 * np.linalg.norm(images[-1]):
            break
        basis.append(q / size)
        b = root * basis[-1]
        q = root * laplacian.solve(b - root * root * (b.sum() / (root @ root)))
        q = q - null * (null @ q)
        images.append(q)
        small = np.array(basis) @ np.array(images).T
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        if np.linalg.norm(vectors[:, -1] @ np.array(images) - values[-1] * (vectors[:, -1] @ np.array(basis))) <= 1e-10 * values[-1]:
            break
    else:
        if step + 1 < n - 1:
            raise ArithmeticError(f"no eigenvector of {n} nodes after {most} steps")
    v = vectors[:, -1] @ np.array(basis)
    return float(1 / values[-1]), v / np.linalg.norm(v)


def distances(n: int, links: dict[tuple[int, int], float]) -> np.ndarray:
    """Shortest weighted paths between all nodes; 1e6 where there is none."""
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for (a, b), w in links.items():
        near[a].append((b, w))
        near[b].append((a, w))
    out = np.full((n, n), 1e6)
    for s in range(n):
        out[s, s] = 0
        heap = [(0.0, s)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > out[s, x]:
                continue
            for y, w in near[x]:
                if d + w < out[s, y]:
                    out[s, y] = d + w
                    heapq.heappush(heap, (d + w, y))
    return out


def magnitude(d: np.ndarray, t: float = 1.0) -> np.ndarray:
    """Each node's share: the solution of Z w = 1 with Z = exp(-t d); zeros if Z can't be solved."""
    try:
        return np.linalg.solve(np.exp(-t * d), np.ones(len(d)))
    except np.linalg.LinAlgError:
        return np.zeros(len(d))


def magnitude_of(n: int, links: dict[tuple[int, int], float], t: float = 1.0) -> np.ndarray:
    """magnitude(distances(n, links), t), without the pairs that are farther apart than FAR / t.

    A path that counts has short edges only: nodes that no such path joins don't touch each other's share, so each
    group of joined nodes is solved by itself; small groups as dense matrices, others by conjugate residuals.
    """
    if n <= DENSE:
        return magnitude(distances(n, links), t)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for (a, b), w in links.items():
        if t * w <= FAR:
            near[a].append((b, w))
            near[b].append((a, w))
    out, seen = np.zeros(n), [False] * n
    for s in range(n):
        if seen[s]:
            continue
        group, seen[s] = [s], True
        for x in group:
            for y, _ in near[x]:
                if not seen[y]:
                    seen[y] = True
                    group.append(y)
        share = _share(group, near, t)
        if share is None:
            return np.zeros(n)
        out[group] = share
    return out


def _share(group: list[int], near: list[list[tuple[int, float]]], t: float) -> np.ndarray | None:
    """The shares of a group of nodes; None if its matrix can't be solved."""
    at, m = {x: k for k, x in enumerate(group)}, len(group)
    rows, cols, vals = [], [], []
    for x in group:
        far, done, heap = {x: 0.0}, set(), [(0.0, x)]
        while heap:
            d, y = heapq.heappop(heap)
            if y in done:
                continue
            done.add(y)
            for z, w in near[y]:
                if t * (d + w) <= FAR and d + w < far.get(z, np.inf):
                    far[z] = d + w
                    heapq.heappush(heap, (d + w, z))
        rows.append(np.full(len(far), at[x]))
        cols.append(np.array([at[y] for y in far]))
        vals.append(np.exp(-t * np.array(list(far.values()))))
    i, j, z = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
    if m > DENSE:
        times = lambda v: np.bincount(i, z * v[j], m)
        x, r = np.zeros(m), np.ones(m)
        p, zr = r.copy(), times(r)
        zp = zr.copy()
        for _ in range(m):
            if np.linalg.norm(r) <= 1e-12 * m**0.5:
                return x
            bend = r @ zr
            step = bend / (zp @ zp)
            x, r = x + step * p, r - step * zp
            zr = times(r)
            p, zp = r + (r @ zr) / bend * p, zr + (r @ zr) / bend * zp
    full = np.zeros((m, m))
    full[i, j] = z
    try:
        return np.linalg.solve(full, np.ones(m))
    except np.linalg.LinAlgError:
        return None


def betweenness(n: int, links: dict[tuple[int, int], float], pivots: int = 200, seed: int = 7) -> np.ndarray:
    """Brandes over weights as distances, from all nodes or, above ``pivots``, from a fixed sample scaled up; normalised for undirected graphs."""
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for (a, b), w in sorted(links.items()):
        near[a].append((b, w))
        near[b].append((a, w))
    starts = range(n) if n <= pivots else sorted(np.random.default_rng(seed).choice(n, pivots, replace=False).tolist())
    out = np.zeros(n)
    for s in starts:
        far, paths, before, order = {s: 0.0}, np.zeros(n), [[] for _ in range(n)], []
        paths[s], done, heap = 1, set(), [(0.0, s)]
        while heap:
            d, x = heapq.heappop(heap)
            if x in done:
                continue
            done.add(x)
            order.append(x)
            for y, w in near[x]:
                if y not in far or d + w < far[y] - 1e-12:
                    far[y], paths[y], before[y] = d + w, paths[x], [x]
                    heapq.heappush(heap, (d + w, y))
                elif abs(d + w - far[y]) <= 1e-12 and y not in done:
                    paths[y] += paths[x]
                    before[y].append(x)
        depends = np.zeros(n)
        for y in reversed(order):
            for x in before[y]:
                depends[x] += paths[x] / paths[y] * (1 + depends[y])
            if y != s:
                out[y] += depends[y]
    scale = (n / len(starts)) / ((n - 1) * (n - 2)) if n > 2 else 0.0
    return out * scale


def spectral_features(edges: DataFrame, t: float = 1.0, large: int = LARGE, measures: tuple[str, ...] = ("fiedler", "magnitude", "betweenness")) -> DataFrame:
    """node_id and, of the measures asked for, spectral_gap and fiedler_coord, magnitude, betweenness of each node of a component of three nodes or more; two nodes have nothing to measure.

    Components of more than ``large`` nodes are worked on by joins, with the same results, but for three cases: of more than
    200 nodes there, betweenness takes other pivots; edges without a positive weight are no way there; a Fiedler vector that
    isn't unique may be another one.
    """
    rows = stored(by_component(edges).where("nodes >= 3").select("component", "src", "dst", "weight", "nodes"), "graph")
    columns = {"fiedler": ("spectral_gap", "fiedler_coord"), "magnitude": ("magnitude",), "betweenness": ("betweenness",)}
    names = [c for m in measures for c in columns[m]]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, links = _graph(pdf)
        n = len(ids)
        out = {"node_id": ids}
        if "fiedler" in measures:
            out["spectral_gap"], out["fiedler_coord"] = fiedler(n, links)
        if "magnitude" in measures:
            out["magnitude"] = magnitude_of(n, links, t)
        if "betweenness" in measures:
            out["betweenness"] = betweenness(n, links)
        return pd.DataFrame(out)

    schema = ", ".join(["node_id string", *[f"{c} double" for c in names]])
    small = rows.where(F.col("nodes") <= large).drop("nodes")
    small = small.repartition(1 + small.count() // TASK_EDGES, "component").groupBy("component").applyInPandas(run, schema)
    giant = rows.where(F.col("nodes") > large).drop("nodes")
    if giant.isEmpty():
        return small
    joined = {"fiedler": lambda: spectra.fiedler(giant), "magnitude": lambda: spectra.magnitude(giant, t), "betweenness": lambda: spectra.betweenness(giant)}
    found = reduce(lambda a, b: a.join(b, ["component", "node_id"]), [joined[m]() for m in measures])
    return small.unionByName(found.select("node_id", *names))
