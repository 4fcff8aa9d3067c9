"""Vector searches against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import nearest
from lodestone.operators.nearest import VectorIndex


def brute(vectors, queries, k, own, ok=lambda r: True):
    fine = lambda x: x is not None and None not in x and all(map(math.isfinite, x)) and any(x)
    out = []
    for q, x in queries:
        if fine(x) and q is not None:
            near = [(-round(float(np.dot(x, r[1]) / np.linalg.norm(x) / np.linalg.norm(r[1])), 6), r[0]) for r in vectors if r[0] is not None and fine(r[1]) and len(r[1]) == len(x) and (own or r[0] != q) and ok(r)]
            out += [(q, v, -s + 0.0, i + 1) for i, (s, v) in enumerate(sorted(near)[:k])]
    return sorted(out)


def _data():
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + 0.25 * rng.standard_normal(16)).round(3).tolist(), i % 4, None if i % 10 == 9 else f"t{i % 3}") for i in range(600)]
    odd = [(900, None, 0, "t0"), (901, [0.0] * 16, 0, "t0"), (902, [float("nan")] * 16, 0, "t0"), (903, [None, *[1.0] * 15], 0, "t0"), (904, [1.0, 2.0], 0, "t0"), (None, rows[0][1], 0, "t0"), rows[5], rows[5], (905, rows[5][1], 1, "t2")]
    return rows + odd, [(r[0], r[1]) for r in rows[::37]] + [(904, [1.0, 2.0]), (950, [0.0] * 16), (951, None)]


@pytest.mark.parametrize("own", [True, False])
def test_exact_searches(spark, monkeypatch, own):
    monkeypatch.setattr(nearest, "BLOCK", 50)
    monkeypatch.setattr(nearest, "ASKED", 5)
    rows, queries = _data()
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, tier int, kind string").repartition(3)
    q = spark.createDataFrame(queries, "query_id long, query array<double>")
    got = sorted((r.query_id, r.vec_id, round(r.score, 6), r["rank"]) for r in nearest.knn(v, q, 7, own).collect())
    assert got == brute(rows, queries, 7, own) and nearest.knn(v.limit(0), q, 3).count() == nearest.knn(v, q.limit(0), 3).count() == 0


def test_an_index_finds_the_same_and_looks_into_few_cells(spark, tmp_path):
    rows, queries = _data()
    queries = [q for q in queries if q[0] != 904]  # an index has one length
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, tier int, kind string").repartition(3)
    q = spark.createDataFrame(queries, "query_id long, query array<double>")
    index = VectorIndex.build(v, f"file://{tmp_path}/ix", 12, ("tier", "kind"))
    short = [r for r in rows if r[0] != 904]
    for where, ok in ((None, lambda r: True), ((F.col("tier") <= 1) & (F.col("kind") == "t1"), lambda r: r[2] <= 1 and r[3] == "t1")):
        found = index.search(q, 5, where, probes=1).collect()
        assert sorted((r.query_id, r.vec_id, round(r.score, 6), r["rank"]) for r in found) == brute(short, queries, 5, True, ok)
        if where is None:
            assert sum({r.query_id: r.cells for r in found}.values()) < 5 * len({r.query_id for r in found})  # of 12
    quick = index.search(q, 5, probes=2, exact=False).collect()
    want = {(a, b) for a, b, _, _ in brute(short, queries, 5, True)}
    assert {r.cells for r in quick} == {2} and len({(r.query_id, r.vec_id) for r in quick} & want) >= 0.95 * len(want)
    again = VectorIndex(spark, f"file://{tmp_path}/ix").search(q, 10_000, own=False)
    assert again.count() == len(brute(short, queries, 10_000, False))
    none = VectorIndex.build(v.limit(0), f"file://{tmp_path}/none", 4)
    assert none.search(q, 3).count() == 0


def test_blocks_of_an_index_are_full_and_a_second_round_wants_nothing_worse(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    v = spark.createDataFrame([(i, rng.standard_normal(8).tolist(), i % 2) for i in range(800)], "vec_id long, embedding array<double>, tier int").repartition(16)
    index = VectorIndex.build(v, f"file://{tmp_path}/ix", 4, ("tier",))
    assert index.blocks.count() == 8  # of 4 cells and 2 tiers, however many tasks dealt the vectors
    kept = []
    look = VectorIndex._look
    monkeypatch.setattr(VectorIndex, "_look", lambda *a: kept.append(look(*a)) or kept[-1])
    q = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    found = {r.query_id: r.worst for r in index.search(q, 5, probes=2).groupBy("query_id").agg(F.min("score").alias("worst")).collect()}
    first, second = (part.collect() for part in kept)
    worst = {x: sorted((r.score for r in first if r.query_id == x), reverse=True)[4] for x in found}
    assert len(found) == 40 and all(r.score >= worst[r.query_id] - 2e-6 for r in second) and len(second) < len(first)
    few, many = (nearest._best_of(np.array([[0.5, 0.9, 0.9, 0.5], [0.1, -3.0, 0.1, 0.1]]), np.array([f, -2.0]), 2) for f in (0.6, -2.0))
    assert [x.tolist() for x in few] == [x.tolist() for x in many] == [[0, 0, 1, 1], [1, 2, 0, 2]]
