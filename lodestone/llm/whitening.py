"""Whitening of embeddings by a matrix-free block Lanczos method on their covariance.

Vectors become whole numbers; each distinct one counts once. The distinct vectors lie in a stored table of blocks. The
covariance itself is never made: every step is a pass over the blocks in which each task centres its vectors, multiplies
them with a few directions and adds up ``X^T (X v)``; Spark sums the tasks' results, and the driver gets one number for each
dimension and direction. All earlier directions are kept and every new block is made orthogonal to them, twice. Where a
block breaks down (a direction that the space holds already), a random direction outside of the space takes its place. The
method ends once the residuals of the wanted components are as small as rounding lets them be, or the space is whole.

Trace and deviations are sums of whole numbers and exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored, tidy

#: Fixed value: steps of a whole number in one unit of an embedding.
STEPS = 256
#: Directions of a Lanczos block at least; residual, as a share of the largest eigenvalue, at which a component has converged, and at which it may stand still; bytes of a block of vectors.
WIDTH, CONVERGED, ROUNDING, BLOCK_BYTES = 4, 1e-14, 1e-12, 4 << 20
#: Whole numbers below this are added in 64 bits, others with as many digits as they take; bits of a limb.
EXACT, LIMB = 2**62, 36


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, x): the vectors that hold no nulls and no NaN or infinity, as floor(256 c) each."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select("vec_id", "embedding").where(F.coalesce(finite, F.lit(False)))
    return rows.select("vec_id", F.transform("embedding", lambda c: F.floor(c.cast("double") * F.lit(float(STEPS)))).alias("x"))


def _matrices(column: pd.Series, dim: int) -> Iterator[np.ndarray]:
    for raw in column:
        yield np.frombuffer(raw, "<i8").reshape(-1, dim)


class FitList:
    """Each distinct vector once, in blocks: n, dim, sums (exact, one a dimension)."""

    def __init__(self, rows: DataFrame) -> None:
        """rows: (x). The dimension is that of most distinct vectors, of two the smaller one; vectors of another are left out."""
        distinct = stored(rows.select("x").where(F.size("x") > 0).distinct(), "distinct")
        sizes = distinct.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
        self.n, self.dim = (sizes["n"], sizes["dim"]) if sizes else (0, 0)
        if not self.n:
            return
        dim, most = self.dim, max(1, BLOCK_BYTES // (8 * self.dim))

        def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for at in range(0, len(b), most):
                    yield pd.DataFrame({"block": [np.stack(b["x"].iloc[at : at + most].to_numpy()).astype("<i8").tobytes()]})
            tidy()

        self.blocks = stored(distinct.where(F.size("x") == dim).mapInPandas(blocks, "block binary"), "blocks")
        dropped(distinct)
        totals = self._summed(lambda x: [sum(map(int, c)) for c in x.T] if _large(x, len(x)) else x.sum(0).tolist())
        self.sums = totals

    def _summed(self, of: Callable[[np.ndarray], list | np.ndarray]) -> list:
        """The sum over all blocks of a few numbers each, in their order: doubles, or whole numbers of any size. A task sends its own sums only.

        Whole numbers travel as limbs of LIMB bits, of which Spark can add millions in 64 bits.
        """
        dim = self.dim

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: list | np.ndarray | None = None
            for b in batches:
                for x in _matrices(b["block"], dim):
                    part = of(x)
                    if total is None:
                        total = part
                    else:
                        total = total + part if isinstance(part, np.ndarray) else [s + t for s, t in zip(total, part, strict=True)]
            tidy()
            if isinstance(total, np.ndarray):
                yield pd.DataFrame({"at": np.arange(len(total)), "limb": -1, "whole": 0, "v": total})
            elif total is not None:
                rows = [(i, k, (-1 if t < 0 else 1) * (abs(t) >> LIMB * k & (1 << LIMB) - 1), 0.0) for i, t in enumerate(total) for k in range(max(1, -(-abs(t).bit_length() // LIMB)))]
                yield pd.DataFrame(rows, columns=["at", "limb", "whole", "v"])

        sums = self.blocks.mapInPandas(run, "at long, limb long, whole long, v double").groupBy("at", "limb").agg(F.sum("whole").alias("whole"), F.sum("v").alias("v")).collect()
        out: dict[int, int | float] = {}
        for r in sums:  # a few for each dimension and direction
            out[r["at"]] = out.get(r["at"], 0) + ((r["whole"] << LIMB * r["limb"]) if r["limb"] >= 0 else r["v"])
        return [out[i] for i in sorted(out)]

    def trace_sum(self) -> int:
        """Sum over the list of each vector's deviation, exact."""
        n, sums = self.n, self.sums
        return self._summed(lambda x: [sum(deviations(x, n, sums))])[0]

    def times(self, q: np.ndarray) -> np.ndarray:
        """Covariance times q (dim, few): one pass."""
        n, sums = self.n, self.sums

        def of(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            return (c.T @ (c @ q)).ravel()

        return np.array(self._summed(of)).reshape(q.shape) / n

    def moments(self, project: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(means, covariance) of the list's centred vectors times ``project`` (dim, few)."""
        n, sums, k = self.n, self.sums, project.shape[1]

        def of(x: np.ndarray) -> np.ndarray:
            w = centred(x, n, sums) @ project
            return np.concatenate([w.sum(0), (w.T @ w).ravel()])

        got = np.array(self._summed(of)) / n
        return got[:k], got[k:].reshape(k, k) - np.outer(got[:k], got[:k])


def _large(x: np.ndarray, times: int, least: int = 0) -> bool:
    """Could sums of ``times`` such numbers, or of these less ``least``, need more than 64 bits?"""
    high = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    return high * times + least >= EXACT


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S: 64-bit numbers where these hold it, else Python's."""
    if _large(x, n, max(map(abs, sums))):
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * n - np.array(sums, np.int64)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x less its mean: the difference is exact, the division rounds once."""
    return _numerators(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over the dimensions of (n x - S)^2, exact."""
    a = _numerators(x, n, sums)
    high = max(abs(int(a.max())), abs(int(a.min()))) if a.size else 0
    if high * high * x.shape[1] >= EXACT:
        a = a.astype(object)
    return (a * a).sum(1).tolist()


def _outside(block: np.ndarray, basis: np.ndarray, rng: np.random.Generator, floor: float) -> np.ndarray:
    """Orthonormal columns for the part of block that lies outside of basis.

    A column that the basis and the columns before it hold up to ``floor`` gives way to a random one, as long as there is room.
    """
    dim, columns = len(block), []
    for v in block.T[: max(0, dim - basis.shape[1])]:
        held, size = np.column_stack([basis, *columns]), 0.0
        for _ in range(2):
            v = v - held @ (held.T @ v)
        if (size := float(np.linalg.norm(v))) <= floor:  # a breakdown: start again from somewhere else
            v = rng.standard_normal(dim)
            for _ in range(3):
                v = v - held @ (held.T @ v)
                v, size = v / np.linalg.norm(v), 1.0
        columns.append(v / size)
    return np.column_stack(columns) if columns else np.zeros((dim, 0))


def largest_components(times: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric map of which only ``times`` is known."""
    rng, width, before = np.random.default_rng(seed), min(dim, max(WIDTH, wanted)), np.inf
    basis, images = np.zeros((dim, 0)), np.zeros((dim, 0))
    block = _outside(rng.standard_normal((dim, width)), basis, rng, 0.0)
    while True:
        basis, image = np.column_stack([basis, block]), times(block)
        images = np.column_stack([images, image])
        small = basis.T @ images  # the map within the space
        values, inner = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values)[: min(wanted, len(values))]
        vectors, scale = basis @ inner[:, order], max(float(np.abs(values).max()), 1e-300)
        residual = float(np.linalg.norm(images @ inner[:, order] - vectors * values[order], axis=0).max()) / scale
        settled = residual <= CONVERGED or residual <= ROUNDING and residual > before / 2  # rounding lets it fall no further
        if basis.shape[1] == dim or settled:
            return values[order], vectors / np.linalg.norm(vectors, axis=0)
        before, block = residual, _outside(image, basis, rng, 1e-13 * scale)


def whiten(vectors: DataFrame, wanted: int = 4) -> DataFrame:
    """(vec_id, embedding) -> vec_id, component (from 1), n, deviation, whitened, explained, identity_error: for each usable row up to ``wanted`` rows.

    Usable are vectors without nulls and non-finite numbers, of the commonest dimension among the distinct ones, the
    smaller of two; a null id is an id like others. Statistics are those of the distinct vectors, so rows that repeat change
    nothing and are each returned. Components without variance (all vectors alike, fewer vectors or dimensions than
    components) have no rows. A deviation that 64 bits can't hold is null. Numbers whose multiple by 256 leaves 64 bits
    count as the nearest that doesn't. An empty table gives no rows; other columns are not looked at.
    """
    spark, kind = vectors.sparkSession, vectors.schema["vec_id"].dataType.simpleString()
    rows = whole_numbers(vectors)
    fit, schema = FitList(rows), f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not fit.n:
        return spark.createDataFrame([], schema)
    trace = fit.trace_sum() / fit.n**3
    values, directions = largest_components(fit.times, fit.dim, wanted)
    kept = values > 1e-12 * trace if trace else np.zeros(len(values), bool)
    values, directions = values[kept], directions[:, kept]
    if not len(values):
        return spark.createDataFrame([], schema)
    project = directions / np.sqrt(values)
    means, covariance = fit.moments(project)
    error, shares = float(np.abs(covariance - np.eye(len(values))).max()), values / trace
    n, dim, sums, k = fit.n, fit.dim, fit.sums, len(values)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.stack(b["x"].to_numpy()).astype("<i8")
                far = [str(d) if d < 2**63 else None for d in deviations(x, n, sums)]
                w = centred(x, n, sums) @ project
                yield pd.DataFrame({"vec_id": np.repeat(b["vec_id"].to_numpy(), k), "component": np.tile(np.arange(1, k + 1), len(b)), "deviation": np.repeat(np.array(far, object), k), "whitened": w.ravel(), "explained": np.tile(shares, len(b))})
        tidy()

    usable = rows.where(F.size("x") == dim).select(F.col("vec_id").cast("string").alias("vec_id"), "x")  # ids as text: long ones beside null ones stay exact
    out = usable.mapInPandas(run, "vec_id string, component int, deviation string, whitened double, explained double")
    return out.select(F.col("vec_id").cast(kind).alias("vec_id"), "component", F.lit(n).cast("long").alias("n"), F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", F.lit(error).alias("identity_error"))
