"""Entity resolution as joins within blocks: exact keys, equal names, near embeddings; then components and survivors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import clean_key, edge_id, series_id
from ..functions.text import blocking_key, normalise_name
from ..sources.shared import stored
from .components import connected_components
from .joins import heavy_keys, spread_join

MATCH = ("a", "b", "method", "score")
#: Pivots that vectors are dealt to, and the cosine from which on they can prune; vectors on each side of a tile.
PIVOTS, PRUNING, TILE = 64, 0.9, 4096


def _pairs(rows: DataFrame, on: list[str], method: str, score: float) -> DataFrame:
    """Links of the rows that agree in ``on``: each to the smallest id of its group, which says as much as all pairs."""
    least = rows.groupBy(*on).agg(F.min("node_id").alias("a"))
    return rows.join(least, on).where("node_id != a").select("a", F.col("node_id").alias("b"), F.lit(method).alias("method"), F.lit(score).alias("score"))


def keep_links(old: DataFrame, new: DataFrame) -> DataFrame:
    """Links of earlier runs and of this one (a, b, method, score, run): of each pair the best score, with its method, and the first run that found it."""
    both = old.unionByName(new.select(*old.columns))
    kept = both.groupBy("a", "b").agg(F.max(F.struct("score", "method")).alias("best"), F.min("run").alias("run"))
    return kept.select("a", "b", "best.method", "best.score", "run")


def with_names(rows: DataFrame) -> DataFrame:
    """(node_id, node_type, name, canonical_key, country) with norm_name, block and clean_key."""
    return rows.withColumns({"norm_name": normalise_name(F.col("name")), "block": blocking_key(F.col("node_type"), F.col("country"), F.col("name")), "clean_key": clean_key(F.col("canonical_key"))})


def match_exact(rows: DataFrame) -> DataFrame:
    return _pairs(with_names(rows).where("clean_key != ''"), ["node_type", "clean_key"], "exact", 1.0)


def match_names(rows: DataFrame) -> DataFrame:
    """Equal normalised names of four letters or more, within a block."""
    return _pairs(with_names(rows).where("length(norm_name) >= 4"), ["block", "norm_name"], "rule", 0.95)


def match_embeddings(vectors: DataFrame, block: str, least: float = 0.92) -> DataFrame:
    """(node_id, embedding, block): pairs within a block whose cosine reaches ``least``, all of them.

    Every vector is at home with the nearest of a few pivots and a guest with each pivot that is at most twice the widest
    angle farther away. By the triangle inequality a vector's partners are all at home or guests where it is at home, so
    only these meet. Below PRUNING angles are too wide for that and one pivot serves all. Cells are cut into tiles of some
    TILE vectors, whatever the size of a block, and tiles are compared as matrices. Vectors that are null, zero or hold
    null or non-finite components have no partners; nor have vectors of different lengths or without a block.
    """
    one = vectors.select(F.col(block).alias("blk"), F.col("node_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    one = one.where("blk IS NOT NULL AND id IS NOT NULL AND vec IS NOT NULL").where(~odd & F.exists("vec", lambda x: x != 0))
    wide, kinds = 2 * float(np.arccos(min(max(least, -1.0), 1.0))) + 1e-6, {f.name: f.dataType.simpleString() for f in one.schema}
    pivots = [np.array(r.vec) for r in one.orderBy(F.xxhash64("id"), "id").limit(PIVOTS if least >= PRUNING else 1).collect()]

    def settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for size, some in rows.groupby(rows["vec"].map(len)):
                near = np.array([p / np.linalg.norm(p) for p in pivots if len(p) == size] or [np.eye(1, size)[0]])
                units = np.array(some["vec"].tolist())
                angles = np.arccos(np.clip((units / np.linalg.norm(units, axis=1)[:, None]) @ near.T, -1, 1))
                home = angles.argmin(1)
                who, cell = np.nonzero(angles <= angles.min(1)[:, None] + wide)
                out = some.iloc[who].assign(size=size, cell=cell, home=home[who])
                yield out[["blk", "size", "cell", "home", "id", "vec"]]

    key = ["blk", "size", "cell"]
    rows = stored(one.mapInPandas(settled, f"blk {kinds['blk']}, size int, cell int, home int, id {kinds['id']}, vec array<double>"), "cells")
    tiles = rows.groupBy(*key).agg(F.ceil(F.sum((F.col("home") == F.col("cell")).cast("int")) / TILE).alias("rows"), F.ceil(F.count("*") / TILE).alias("columns")).where("rows > 0")
    rows = spread_join(rows, tiles, key, heavy_keys(rows, key))
    across = rows.where("home = cell").withColumns({"i": F.pmod(F.xxhash64("id"), "rows"), "j": F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)), "across": F.lit(True)})
    down = rows.withColumns({"j": F.pmod(F.xxhash64("id", F.lit(1)), "columns"), "i": F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)), "across": F.lit(False)})

    def compared(tile: pd.DataFrame) -> pd.DataFrame:
        a, b = tile[tile["across"]], tile[~tile["across"]]
        if a.empty or b.empty:
            return pd.DataFrame({"a": [], "b": [], "score": []})
        u, v = np.array(a["vec"].tolist()), np.array(b["vec"].tolist())
        lengths, found, homes = np.linalg.norm(v, axis=1), [], b["home"].to_numpy()
        names, others, cell = a["id"].to_numpy(), b["id"].to_numpy(), int(tile["cell"].iloc[0])
        for at in range(0, len(u), 512):
            score = (u[at : at + 512] @ v.T) / (np.linalg.norm(u[at : at + 512], axis=1)[:, None] * lengths)
            x, y = np.nonzero(score >= least)
            first, second = names[at + x], others[y]
            kept = (homes[y] > cell) & (first != second) | (homes[y] == cell) & (first < second)  # two homes: the first one's cell counts
            found.append(pd.DataFrame({"a": first[kept], "b": second[kept], "score": score[x, y][kept]}))
        return pd.concat(found)

    pairs = across.unionByName(down).groupBy(*key, "i", "j").applyInPandas(compared, f"a {kinds['id']}, b {kinds['id']}, score double")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit("embedding").alias("method"), "score")


def same_as(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """node_id -> canonical_id, method, score: the survivor has most sources, then confidence, then the shortest name, then the smallest id."""
    clusters = connected_components(matches, "a", "b").withColumnRenamed("node", "node_id")
    members = clusters.join(rows.select("node_id", "name", "n_sources", "confidence"), "node_id")
    key = F.struct(-F.col("n_sources"), -F.col("confidence"), F.length("name"), "node_id")
    survivors = members.groupBy("root").agg(F.min(key).alias("k")).select("root", F.col("k.node_id").alias("canonical_id"))
    ends = matches.select(F.col("a").alias("node_id"), "method", "score").unionByName(matches.select(F.col("b").alias("node_id"), "method", "score"))
    best = ends.groupBy("node_id").agg(F.max_by(F.struct("method", "score"), F.struct("score", "method")).alias("best"))
    out = members.select("node_id", "root").join(survivors, "root").where("node_id != canonical_id").join(best, "node_id", "left")
    return out.select("node_id", "canonical_id", F.coalesce("best.method", F.lit("cluster")).alias("method"), F.coalesce("best.score", F.lit(0.9)).alias("score"))


def repoint(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Edges between survivors: ids made anew, loops dropped, parallel ones merged: weights summed, the widest validity (an open end stays open)."""
    one = mapping.select("node_id", "canonical_id")
    rows = edges.join(one.select(F.col("node_id").alias("src"), F.col("canonical_id").alias("s")), "src", "left").join(one.select(F.col("node_id").alias("dst"), F.col("canonical_id").alias("d")), "dst", "left")
    rows = rows.withColumns({"src": F.coalesce("s", "src"), "dst": F.coalesce("d", "dst")}).where("src != dst")
    widest = [F.min("valid_from").alias("valid_from")]
    if "valid_to" in edges.columns:
        widest.append(F.when(~F.bool_or(F.col("valid_to").isNull()), F.max("valid_to")).alias("valid_to"))
    merged = rows.groupBy("src", "dst", "edge_type").agg(F.sum("weight").alias("weight"), *widest)
    return merged.withColumns({"edge_id": edge_id(F.col("src"), F.col("edge_type"), F.col("dst"), F.col("valid_from")), "series_id": series_id(F.col("src"), F.col("edge_type"), F.col("dst"))})
