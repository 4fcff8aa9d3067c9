"""Nearest vectors by cosine: exact searches in blocks, and a stored index of cells that says which blocks can hold anything nearer.

Vectors travel as unit vectors in blocks of a few thousand, each a matrix; queries in blocks of a few hundred. A task takes a
pair of blocks, multiplies them and keeps the k best of each query. The index deals vectors to cells around centres; by the
triangle inequality for angles a vector of a cell is at least the query's angle to the centre less the cell's radius away.
A first round looks into each query's nearest cells; the k-th best found there bounds what is left, and a second round looks
into the cells that can still hold a nearer vector, and no others. So the result is exact, whatever the number of probes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.shared import stored

#: Vectors and queries of a block; vectors that centres are fitted on at most, those with the smallest hashes of their ids.
BLOCK, ASKED, FIT_ROWS = 4_096, 256, 20_000
#: Angles are trusted to this much.
SLACK = 1e-7


def usable(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Rows with an id and a vector that is not null, not zero, and holds neither nulls nor non-finite numbers; the vector as doubles."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where(F.col(id_column).isNotNull() & F.coalesce(finite, F.lit(False))).where(F.exists(vector, lambda x: x != 0))
    return kept.withColumn(vector, F.col(vector).cast("array<double>"))


def _units(column: pd.Series) -> np.ndarray:
    m = np.stack(column.to_numpy())
    return m / np.linalg.norm(m, axis=1)[:, None]


def _in_blocks(rows: DataFrame, id_column: str, vector: str, by: list[str], size: int, floor: str | None = None) -> DataFrame:
    """by..., dim, ids (array, in order), units (binary): unit vectors of up to ``size`` rows that agree in ``by``; with ``floor`` that column, too, as floors (array)."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            dims = b[vector].map(len)
            for key, part in b.groupby([*by, dims.rename("__dim")], dropna=False) if len(b) else []:
                part = part.sort_values(id_column, kind="stable")
                for at in range(0, len(part), size):
                    some = part.iloc[at : at + size]
                    head = {c: [None if pd.isna(v) else v] for c, v in zip(by, key, strict=False)}
                    more = {"floors": [some[floor].to_numpy()]} if floor else {}
                    yield pd.DataFrame(head | {"dim": [int(key[-1])], "ids": [some[id_column].to_numpy()], "units": [_units(some[vector]).tobytes()]} | more)

    schema = ", ".join([*[f"{c} {kinds[c]}" for c in by], "dim int", f"ids array<{kinds[id_column]}>", "units binary", *["floors array<double>"] * bool(floor)])
    return rows.select(*by, id_column, vector, *[floor] * bool(floor)).mapInPandas(run, schema)


def _best_of(scores: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of each row's k largest scores that reach its floor, the largest first; of equal ones the first columns."""
    held = scores >= floor[:, None]
    if len(full := np.flatnonzero(held.sum(1) > k)):
        n = scores.shape[1]
        held[full] &= scores[full] >= np.partition(scores[full], n - k, axis=1)[:, n - k, None]
    rows, columns = np.nonzero(held)
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[kept], columns[kept]


def _k_best(pairs: DataFrame, k: int, own: bool, digits: int) -> DataFrame:
    """(ids, units, asked_ids, asked, floors, dim) -> query_id, vec_id, score: of each pair of blocks the k best of each query, none of less than its floor."""
    kinds = {f.name: f.dataType.simpleString().removeprefix("array<").removesuffix(">") for f in pairs.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ids, units, asked_ids, asked, floors, dim in zip(b["ids"], b["units"], b["asked_ids"], b["asked"], b["floors"], b["dim"], strict=True):
                x, q = np.frombuffer(units, "<f8").reshape(-1, dim), np.frombuffer(asked, "<f8").reshape(-1, dim)
                scores, ids, asked_ids = np.round(q @ x.T, digits), np.asarray(ids), np.asarray(asked_ids)
                if not own:
                    scores[asked_ids[:, None] == ids] = -np.inf
                rows, columns = _best_of(scores, np.asarray(floors, float), k)  # a block's ids are in order
                if len(rows):
                    yield pd.DataFrame({"query_id": asked_ids[rows], "vec_id": ids[columns], "score": scores[rows, columns]})

    return pairs.select("dim", "ids", "units", "asked_ids", "asked", "floors").mapInPandas(run, f"query_id {kinds['asked_ids']}, vec_id {kinds['ids']}, score double")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("long")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "vec_id", "score", "rank")


def _asked_blocks(queries: DataFrame, by: list[str]) -> DataFrame:
    """Blocks of queries (query_id, query, and, if there is one, floor: the least score that counts)."""
    queries = queries if "floor" in queries.columns else queries.withColumn("floor", F.lit(-2.0))
    rows = _in_blocks(queries, "query_id", "query", by, ASKED, "floor")
    return rows.select(*by, "dim", F.col("ids").alias("asked_ids"), F.col("units").alias("asked"), "floors")


def knn(vectors: DataFrame, queries: DataFrame, k: int, own: bool = True, digits: int = 6) -> DataFrame:
    """Exact: query_id, vec_id, score (cosine, rounded), rank. A stated set of queries (query_id, query) against all vectors (vec_id, embedding), block by block.

    own: whether a query finds the row of its own id. Vectors that are null or zero or hold null or non-finite numbers take
    no part, nor do those of another length than the query. Rows that repeat are found each; ties go to smaller ids.
    """
    asked = stored(_asked_blocks(usable(queries.select("query_id", "query"), "query_id", "query").coalesce(1), []), "asked")
    blocks = _in_blocks(usable(vectors.select("vec_id", "embedding"), "vec_id", "embedding"), "vec_id", "embedding", [], BLOCK)
    pairs = blocks.join(asked.hint("shuffle_replicate_nl") if asked.count() > 64 else F.broadcast(asked), "dim")  # 64 blocks of queries: some 8 MB at 64 numbers a vector
    return _ranked(_k_best(pairs, k, own, digits), k)


class VectorIndex:
    """A stored index: ``cells`` (cell, centre, radius, n) and ``blocks`` by cell and by the columns that searches filter on."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.cells, self.blocks = spark.read.parquet(f"{path}/cells"), spark.read.parquet(f"{path}/blocks")

    @classmethod
    def build(cls, vectors: DataFrame, path: str, cells: int = 64, filters: tuple[str, ...] = (), rounds: int = 10, seed: int = 5) -> VectorIndex:
        """(vec_id, embedding, filters...) -> an index of every usable vector of the commonest length in the fitted sample. Centres are those of spherical k-means on at most FIT_ROWS rows."""
        rows = usable(vectors, "vec_id", "embedding").select("vec_id", "embedding", *filters)
        sample = [r["embedding"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).collect()]
        dims = [len(x) for x in sample]
        dim = max(sorted(set(dims)), key=dims.count, default=0)
        x = np.array([v for v in sample if len(v) == dim], float).reshape(-1, max(dim, 1))
        x = x / np.linalg.norm(x, axis=1)[:, None] if len(x) else x
        rng = np.random.default_rng(seed)
        centres = x[rng.choice(len(x), min(cells, len(x)), replace=False)] if len(x) else np.zeros((0, 1))
        for _ in range(rounds):
            own = (x @ centres.T).argmax(1) if len(x) else np.zeros(0, int)
            for c in range(len(centres)):
                if (at := own == c).any() and np.linalg.norm(total := x[at].sum(0)) > 0:
                    centres[c] = total / np.linalg.norm(total)
        names = [f.simpleString().replace(":", " ", 1) for f in rows.select("vec_id", "embedding", *filters).schema]

        def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    cos = _units(b["embedding"]) @ centres.T
                    yield b.assign(cell=cos.argmax(1).astype(np.int32), angle=np.arccos(np.clip(cos.max(1), -1, 1)))

        dealt_rows = stored(rows.where(F.size("embedding") == dim).mapInPandas(dealt, ", ".join([*names, "cell int", "angle double"])), "dealt")
        held = dealt_rows.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n"))
        made = rows.sparkSession.createDataFrame([(c, v.tolist()) for c, v in enumerate(centres)], "cell int, centre array<double>")
        held.join(made, "cell").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")
        # rows of one cell and one set of filters meet, in as many parts as they fill blocks: blocks are full, and no task has a large cell
        groups = ["cell", *filters]
        counts = dealt_rows.groupBy(*groups).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in groups]
        parts = dealt_rows.alias("r").join(counts.alias("c"), same).select("r.*", F.pmod(F.xxhash64("r.vec_id"), F.col("parts")).alias("part"))
        sorted_rows = parts.repartition(*groups, "part").sortWithinPartitions(*groups, "part")
        _in_blocks(sorted_rows, "vec_id", "embedding", groups, BLOCK).write.mode("overwrite").parquet(f"{path}/blocks")
        return cls(rows.sparkSession, path)

    def _look(self, probes: DataFrame, k: int, where: Column | None, own: bool, digits: int) -> DataFrame:
        """probes (query_id, query, cell, and, if there is one, floor): each query's k best in its cells."""
        blocks = self.blocks if where is None else self.blocks.where(where)
        asked = stored(_asked_blocks(probes.repartition("cell").sortWithinPartitions("cell"), ["cell"]), "asked")
        return _k_best(blocks.join(asked, ["cell", "dim"]), k, own, digits)

    def search(self, queries: DataFrame, k: int, where: Column | None = None, probes: int = 4, exact: bool = True, own: bool = True, digits: int = 6) -> DataFrame:
        """(query_id, query) -> query_id, vec_id, score (cosine, rounded), rank, cells (how many were looked into). ``where``: a condition on the filter columns.

        Not ``exact``, only the nearest ``probes`` cells are looked into. Odd vectors are treated as by knn(); a query id that repeats counts once.
        """
        asked = usable(queries.select("query_id", "query"), "query_id", "query").groupBy("query_id").agg(F.min("query").alias("query"))
        kinds = {f.name: f.dataType.simpleString() for f in asked.schema}
        cells = [(r["cell"], r["radius"], r["centre"]) for r in self.cells.collect()]  # a bounded number
        numbers, radius = np.array([c[0] for c in cells], np.int32), np.array([c[1] for c in cells])
        centres = np.array([c[2] for c in cells], float)

        def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for query_id, q in zip(b["query_id"], b["query"], strict=True):
                    if len(cells) and len(q) == centres.shape[1]:
                        angle = np.arccos(np.clip(centres @ (q / np.linalg.norm(q)), -1, 1))
                        order = np.argsort(angle, kind="stable")
                        yield pd.DataFrame({"query_id": [query_id] * len(order), "query": [q] * len(order), "cell": numbers[order], "place": np.arange(len(order), dtype=np.int32), "least": np.maximum(0, angle - radius)[order]})

        every = stored(asked.mapInPandas(bounded, f"query_id {kinds['query_id']}, query array<double>, cell int, place int, least double"), "bounds")
        near = every.where(F.col("place") < probes)
        first = stored(self._look(near, k, where, own, digits), "first")
        looked = near.groupBy("query_id").agg(F.count("*").alias("cells"))
        if exact:
            kth = _ranked(first, k).groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
            # an angle as wide as the k-th best one, rounded outwards; without k of them all cells are open
            reach = F.when(F.col("n") >= k, F.acos(F.greatest(F.col("worst") - 10.0**-digits, F.lit(-1.0))) + SLACK).otherwise(F.lit(4.0))
            more = every.where(F.col("place") >= probes).join(kth, "query_id", "left").where(F.col("least") <= F.coalesce(reach, F.lit(4.0)))
            # what is worse than the k-th best so far is not wanted
            floor = F.when(F.col("n") >= k, F.col("worst") - 10.0**-digits).otherwise(F.lit(-2.0))
            more = stored(more.select("query_id", "query", "cell", F.coalesce(floor, F.lit(-2.0)).alias("floor")), "more")
            first = first.unionByName(self._look(more, k, where, own, digits))
            looked = looked.unionByName(more.groupBy("query_id").agg(F.count("*").alias("cells"))).groupBy("query_id").agg(F.sum("cells").alias("cells"))
        return _ranked(first, k).join(looked, "query_id")
