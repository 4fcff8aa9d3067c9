"""Communities by joins against plain code."""

import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import communities, louvain
from lodestone.sources.shared import stored


def plain(n: int, links: dict[tuple[int, int], float], resolution: float = 1.0) -> list[int]:
    """Community of each node, one move after another."""
    label = list(range(n))
    size, inner = n, dict(links)
    while True:
        near: list[dict[int, float]] = [{} for _ in range(size)]
        loops = [0.0] * size
        for (a, b), w in inner.items():
            if a == b:
                loops[a] += w
            else:
                near[a][b] = near[a].get(b, 0.0) + w
                near[b][a] = near[b].get(a, 0.0) + w
        strength = [2 * loops[i] + sum(near[i].values()) for i in range(size)]
        total = sum(strength)
        own, weight, moved = list(range(size)), list(strength), bool(total)
        rounds, any_move = 0, False
        while moved and rounds < 50:
            moved, rounds = False, rounds + 1
            for i in range(size):
                ties: dict[int, float] = {}
                for j, w in near[i].items():
                    ties[own[j]] = ties.get(own[j], 0.0) + w
                weight[own[i]] -= strength[i]
                best, gain = own[i], ties.get(own[i], 0.0) - resolution * strength[i] * weight[own[i]] / total
                for c in sorted(ties):
                    g = ties[c] - resolution * strength[i] * weight[c] / total
                    if g > gain + 1e-12:
                        best, gain = c, g
                if best != own[i]:
                    own[i], moved, any_move = best, True, True
                weight[best] += strength[i]
        if not any_move:
            return label
        number = {c: k for k, c in enumerate(dict.fromkeys(own))}
        own = [number[c] for c in own]
        label = [own[x] for x in label]
        nxt: dict[tuple[int, int], float] = {}
        for (a, b), w in inner.items():
            key = (min(own[a], own[b]), max(own[a], own[b]))
            nxt[key] = nxt.get(key, 0.0) + w
        size, inner = len(number), nxt



def frame(spark, links):
    return spark.createDataFrame([(f"n{a:04}", f"n{b:04}", w) for (a, b), w in links.items()], "src string, dst string, weight double")


def score(spark, links, label):
    return louvain.modularity(frame(spark, links), spark.createDataFrame([(f"n{i:04}", str(c)) for i, c in enumerate(label)], "node_id string, community_id string"))


def test_a_ring_of_cliques_and_odd_edges(spark):
    """Nine cliques of four in a ring, a pair apart, parallel edges, loops, edges without weight."""
    links = {(4 * c + i, 4 * c + j): 1.0 for c in range(9) for i in range(4) for j in range(i)} | {(4 * c, (4 * c + 5) % 36): 0.5 for c in range(9)} | {(90, 91): 2.0}
    odd = spark.createDataFrame([("n0000", "n0000", 50.0), ("n0000", "n0020", None), ("n0000", "n0020", 0.0), ("n0001", "n0002", 0.0), ("n0095", "n0096", None)], "src string, dst string, weight double")
    rows = louvain.community_labels(frame(spark, links).unionByName(odd), 3, "abcdefghij").collect()
    zero = {r.node_id: r for r in rows if r.level == 0}
    assert {r.node_id: r.community_id for r in zero.values()} == {f"n{i:04}": f"abcdefgh_L0_n{i // 4 * 4:04}" for i in range(36)} | {"n0090": "abcdefgh_L0_n0090", "n0091": "abcdefgh_L0_n0090"}
    one = {r.node_id: r for r in rows if r.level == 1}
    assert set(one) == {f"n{i:04}" for i in range(36)} and all(zero[x].parent_id == r.community_id for x, r in one.items())
    assert zero["n0090"].parent_id is None  # a single community has no further level
    assert louvain.community_labels(odd).count() == 0


def test_modularity_is_that_of_plain_code_or_more(spark):
    random.seed(2)
    links = {}
    for _ in range(1400):
        a = random.randrange(240)
        b = random.randrange(a // 20 * 20, a // 20 * 20 + 20) if random.random() < 0.7 else random.randrange(240)
        if a != b:
            links[min(a, b), max(a, b)] = random.choice([1.0, 2.0, 0.3])
    ours = stored(louvain.community_labels(frame(spark, links), 1), "ours")
    assert louvain.modularity(frame(spark, links), ours) >= 0.99 * score(spark, links, plain(240, links)) > 0.4
    assert ours.count() == ours.select("node_id").distinct().count() == len({x for k in links for x in k})


def test_runs_are_kept_beside_each_other(spark, tmp_path):
    labels = spark.createDataFrame([(f"n{i}", 0, "L0_a" if i < 4 else "L0_b", None) for i in range(6)], "node_id string, level int, community_id string, parent_id string")
    path = f"file://{tmp_path}/runs"
    louvain.keep_run(labels, path, "r1")
    louvain.keep_run(labels, path, "r2", 1)
    louvain.keep_run(labels.where("node_id = 'n5'"), path, "r2", 1)
    got = sorted((r.run_id, r.community_id, r.member_count, r.node_id) for r in spark.read.parquet(path).collect())
    assert got == [("r1", "L0_a", 4, f"n{i}") for i in range(4)] + [("r2", "L0_b", 1, "n5")]


@pytest.mark.parametrize("rows", [[], [("a", "b", 1.0)]])
def test_tiny_graphs(spark, rows):
    got = louvain.community_labels(spark.createDataFrame(rows, "src string, dst string, weight double")).collect()
    assert len(got) == 2 * len(rows) and len({r.community_id for r in got}) == len(rows)


def test_small_components_are_dealt_out(spark, monkeypatch):
    """Many components of few bytes are the work of many tasks, with the numbers that each has alone."""
    monkeypatch.setattr(communities, "TASK_EDGES", 3)
    ties = [(f"{a}{i:02}", f"{b}{i:02}", 1.0 + i) for i in range(20) for a, b in ("ab", "bc", "ac")]
    found = communities.spectral_features(spark.createDataFrame(ties, "src string, dst string, weight double"), measures=("betweenness", "fiedler"))
    rows = found.withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == 60 and len({r["task"] for r in rows}) > 4
    assert all(r["betweenness"] == 0 and abs(r["spectral_gap"] - 1.5) < 1e-9 for r in rows)
