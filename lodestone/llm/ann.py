"""Nearest neighbours by score-aware (anisotropic) product quantisation, four-bit table scans and exact reranking.

The nearest vectors by Euclidean distance are those with the largest ``q.x - |x|^2 / 2``. The norm is kept as it is; for the
inner product, vectors are cut into subspaces of two dimensions with 16 centres each. A vector that matters to a query
points the query's way, so error along the vector does more harm than error across it: both the centres and the codes
minimise ``|r|^2 + (eta - 1) (r.x / |x|)^2`` for the residual r. Scanning reads codes and norms only and adds up one table
entry for each pair of codes; the best are then looked up by id and measured exactly, on the original vectors, in double
precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Vectors that the centres are fitted on at most (those with the smallest hashes of their ids); rows of an index block; queries of a block.
FIT_ROWS, BLOCK_ROWS, QUERY_ROWS = 10_000, 16_384, 128
#: Shares of the index; each block of queries is a task with each of them.
SHARES = 4
SUB = 2


class Quantizer:
    """Centres (subspaces, 16, SUB) for vectors of ``dim`` numbers, padded to a multiple of 2 * SUB."""

    def __init__(self, sample: np.ndarray, threshold: float = 0.2, rounds: int = 8, seed: int = 7) -> None:
        self.dim = sample.shape[1]
        self.eta = max(1.0, (self.dim - 1) * threshold**2 / (1 - threshold**2))
        x = self._padded(sample)
        rng = np.random.default_rng(seed)
        self.centres = np.stack([x[rng.integers(0, len(x), 16), m] for m in range(x.shape[1])]).astype(np.float64)
        codes = self._nearest(x)
        for _ in range(rounds):
            self._refit(x, codes)
            codes = self.encode_codes(sample, codes)

    def _padded(self, v: np.ndarray) -> np.ndarray:
        width = -(-self.dim // (2 * SUB)) * 2 * SUB
        return np.pad(v.astype(np.float64), ((0, 0), (0, width - self.dim))).reshape(len(v), -1, SUB)

    def _nearest(self, x: np.ndarray) -> np.ndarray:
        return np.stack([((x[:, m, None, :] - self.centres[m]) ** 2).sum(2).argmin(1) for m in range(x.shape[1])], 1)

    def _along(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """r.x of each vector."""
        own = np.stack([self.centres[m][codes[:, m]] for m in range(x.shape[1])], 1)
        return ((x - own) * x).sum((1, 2))

    def encode_codes(self, vectors: np.ndarray, codes: np.ndarray | None = None, sweeps: int = 2) -> np.ndarray:
        """Coordinate descent: each subspace in turn takes the code that makes the loss smallest, the others held."""
        x = self._padded(vectors)
        codes = self._nearest(x) if codes is None else codes.copy()
        weight = (self.eta - 1) / np.maximum((x**2).sum((1, 2)), 1e-30)
        total = self._along(x, codes)
        for _ in range(sweeps):
            for m in range(x.shape[1]):
                r = x[:, m, None, :] - self.centres[m]
                along = (r * x[:, m, None, :]).sum(2)
                rest = total - along[np.arange(len(x)), codes[:, m]]
                codes[:, m] = ((r**2).sum(2) + weight[:, None] * (rest[:, None] + along) ** 2).argmin(1)
                total = rest + along[np.arange(len(x)), codes[:, m]]
        return codes

    def _refit(self, x: np.ndarray, codes: np.ndarray) -> None:
        """Least squares for the centres of each subspace, the others held."""
        weight = (self.eta - 1) / np.maximum((x**2).sum((1, 2)), 1e-30)
        total = self._along(x, codes)
        for m in range(x.shape[1]):
            xm, cm = x[:, m], codes[:, m]
            rest = total - ((xm - self.centres[m][cm]) * xm).sum(1)
            for k in range(16):
                if (at := cm == k).any():
                    y, w = xm[at], weight[at]
                    a = at.sum() * np.eye(SUB) + (y * w[:, None]).T @ y
                    self.centres[m][k] = np.linalg.solve(a, y.sum(0) + (y * (w * (rest[at] + (y * y).sum(1)))[:, None]).sum(0))
            total = rest + ((xm - self.centres[m][cm]) * xm).sum(1)

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Two four-bit codes a byte: (rows, subspaces / 2)."""
        c = self.encode_codes(vectors).astype(np.uint8)
        return c[:, 0::2] | c[:, 1::2] << 4

    def tables(self, query: np.ndarray) -> np.ndarray:
        """(subspaces / 2, 256): inner products of a query with each pair of centres."""
        each = np.einsum("md,mkd->mk", self._padded(query[None])[0], self.centres)
        return (each[0::2, None, :] + each[1::2, :, None]).reshape(-1, 256).astype(np.float32)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding) that take part: not null, not zero, all numbers finite. Null ids take no part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))


def _matrix(column: pd.Series, dtype: str) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(dtype, copy=False)


def build_index(vectors: DataFrame) -> tuple[DataFrame, Quantizer] | None:
    """Every usable row in blocks (ids, packed codes, half the squared norms), in a stored table, and the quantiser; None for no rows.

    The dimension is that of most rows of the fitted sample; rows of another one take no part.
    """
    rows = usable(vectors)
    sample = [r["embedding"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).collect()]
    if not sample:
        return None
    dims = [len(x) for x in sample]
    dim = max(sorted(set(dims)), key=dims.count)
    quantizer = Quantizer(np.array([x for x in sample if len(x) == dim], np.float64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), BLOCK_ROWS):
                part = b.iloc[at : at + BLOCK_ROWS].sort_values("vec_id", kind="stable")
                x = _matrix(part["embedding"], "<f8")
                yield pd.DataFrame({"ids": [part["vec_id"].to_numpy("<i8").tobytes()], "codes": [quantizer.encode(x).tobytes()], "half": [((x**2).sum(1) / 2).astype("<f4").tobytes()]})

    return stored(rows.where(F.size("embedding") == dim).mapInPandas(run, "ids binary, codes binary, half binary"), "codes"), quantizer


def _in_blocks(queries: DataFrame) -> DataFrame:
    """(vec_id, embedding) -> a stored table of blocks of up to QUERY_ROWS queries (ids, vectors as doubles)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), QUERY_ROWS):
                part = b.iloc[at : at + QUERY_ROWS]
                yield pd.DataFrame({"own": [part["vec_id"].to_numpy("<i8").tobytes()], "asked": [_matrix(part["embedding"], "<f8").tobytes()]})

    return stored(queries.select("vec_id", "embedding").mapInPandas(run, "own binary, asked binary"), "queries")


def best_of_block(table: np.ndarray, own: int, ids: np.ndarray, codes: np.ndarray, half: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the ``most`` best rows of a block by the table scan, not in order; of equal scores the smaller ids (the block is in their order)."""
    score = -half
    for j in range(codes.shape[1]):
        score = score + table[j][codes[:, j]]
    keep = ids != own
    if most >= len(ids):
        return score[keep], ids[keep]
    score = np.where(keep, score, -np.inf)
    least = np.partition(score, len(score) - most)[len(score) - most]
    sure, ties = np.flatnonzero(score > least), np.flatnonzero((score == least) & keep)
    at = np.concatenate([sure, ties[: most - len(sure)]])
    return score[at], ids[at]


def scan(index: DataFrame, queries: DataFrame, quantizer: Quantizer, most: int) -> DataFrame:
    """query_id, vec_id, score: the ``most`` best rows of each query in each of SHARES shares of the index by the table scan (a larger score is nearer).

    Each task takes a block of queries over a share of the index's blocks, so what it finds grows with the queries alone.
    """
    blocks = queries.count()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        before, own, tables = None, np.zeros(0, np.int64), []
        for b in batches:
            for ids, codes, half, name, asked in zip(b["ids"], b["codes"], b["half"], b["own"], b["asked"], strict=True):
                if name != before:
                    before, own = name, np.frombuffer(name, "<i8")
                    tables = [quantizer.tables(q) for q in np.frombuffer(asked, "<f8").reshape(len(own), -1)]
                ids, half = np.frombuffer(ids, "<i8"), np.frombuffer(half, "<f4")
                codes = np.asfortranarray(np.frombuffer(codes, np.uint8).reshape(len(ids), -1))
                for q, table in zip(own.tolist(), tables, strict=True):
                    score, found = best_of_block(table, q, ids, codes, half, most)
                    if q in best:
                        score, found = np.concatenate([best[q][0], score]), np.concatenate([best[q][1], found])
                        if len(score) > most:
                            order = np.lexsort((found, -score))[:most]
                            score, found = score[order], found[order]
                    best[q] = score, found
        for q, (score, found) in best.items():
            if len(found):
                yield pd.DataFrame({"query_id": q, "vec_id": found, "score": score.astype(np.float64)})

    # The stated query set against all rows, block by block: pairs of blocks, never pairs of rows.
    pairs = index.coalesce(SHARES).crossJoin(queries.repartition(max(1, blocks)).hint("shuffle_replicate_nl"))
    return pairs.mapInPandas(run, "query_id long, vec_id long, score double")


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, rerank: int = 200) -> DataFrame:
    """(vec_id, embedding) of all rows and of the queries -> query_id, rank (from 1), vec_id, score (Euclidean distance).

    Every usable row is indexed. The codes alone are scanned; the best ``rerank`` of each query in each share of the index are then
    looked up among the vectors and measured exactly, and the k nearest returned, ties by smaller vec_id. A query never
    finds rows with its own id; a query id that repeats counts once, with its smallest vector. Rows that repeat are
    candidates each. Null, zero and non-finite vectors take no part; an empty table gives no rows; other columns are not
    looked at. Queries are a table of blocks: none of them reaches the driver, and the plan is the same for any number.
    """
    spark, made = vectors.sparkSession, build_index(vectors)
    if made is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, quantizer = made
    rows = usable(vectors).where(F.size("embedding") == quantizer.dim)
    asked = usable(queries).where(F.size("embedding") == quantizer.dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = stored(asked.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query")), "asked")
    blocks = _in_blocks(asked.select(F.col("query_id").alias("vec_id"), F.col("query").alias("embedding")))
    near = stored(scan(index, blocks, quantizer, rerank).select("query_id", "vec_id").distinct(), "near")
    # Vectors that very many queries come near to (at most 1,000, as each is in a thousandth of all rows) are sent to where their rows are.
    crowd = max(10_000, near.count() // 1_000)
    heavy = stored(near.groupBy("vec_id").count().where(F.col("count") > crowd).select("vec_id"), "crowded")
    spread = stored(rows.join(F.broadcast(heavy), "vec_id", "left_semi"), "spread")
    spread = F.broadcast(spread) if spread.count() <= 20_000 else spread.hint("merge")  # an id may repeat, too
    found = near.join(F.broadcast(heavy), "vec_id", "left_anti").join(rows, "vec_id").unionByName(near.join(spread, "vec_id"))
    apart = F.zip_with("embedding", "query", lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    measured = found.join(asked, "query_id").select("query_id", "vec_id", F.sqrt(F.aggregate(apart, F.lit(0.0), lambda s, x: s + x)).alias("score"))
    ranked = measured.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
