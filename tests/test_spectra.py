"""Large components by joins give what one task gives."""

import numpy as np
import pandas as pd

from lodestone.operators import communities, spectra


def _two_graphs() -> pd.DataFrame:
    """A wheel of cliques and a bent ladder, with weights that tie some of the paths."""
    rows = []
    for k in range(3):
        names = [f"w{k}{i}" for i in range(3)]
        rows += [(a, b, 1.0 + 0.25 * ((i + j) % 3)) for i, a in enumerate(names) for j, b in enumerate(names) if i < j]
        rows.append((f"w{k}2", f"w{(k + 1) % 3}0", 0.5 + 0.125 * k))
    for i in range(4):
        rows += [(f"a{i}", f"b{i}", 1.0), (f"a{i}", f"a{i + 1}", 0.5), (f"b{i}", f"b{i + 1}", 0.75)]
    return pd.DataFrame(rows, columns=["src", "dst", "weight"])


def _expected(edges: pd.DataFrame, part: str) -> tuple[list, dict]:
    return communities._graph(edges[edges["src"].str[0].isin(list(part))])


def test_joins_agree_with_one_task(spark):
    edges = _two_graphs()
    got = communities.spectral_features(spark.createDataFrame(edges), large=3).toPandas().set_index("node_id")
    assert len(got) == 19 and not got.isna().any().any()
    for part in ("w", "ab"):
        names, links = _expected(edges, part)
        n, mine = len(names), got.loc[names]
        gap, coord = communities.fiedler(n, links)
        assert np.allclose(mine["spectral_gap"], gap, atol=1e-8)
        assert np.allclose(mine["fiedler_coord"], coord, atol=1e-6)
        assert np.allclose(mine["magnitude"], communities.magnitude_of(n, links), atol=1e-8)
        assert np.allclose(mine["betweenness"], communities.betweenness(n, links), atol=1e-10)


def test_restarted_directions(spark):
    edges = _two_graphs().assign(component=lambda x: np.where(x["src"].str[0] == "w", "w", "l"))
    got = spectra.fiedler(spark.createDataFrame(edges), width=5, kept=2).toPandas().set_index("node_id")
    for part in ("w", "ab"):
        names, links = _expected(edges, part)
        assert np.allclose(got.loc[names]["spectral_gap"], communities.fiedler(len(names), links)[0], atol=1e-8)


def test_far_nodes_and_pivots(spark):
    rows = pd.DataFrame([("c", f"n{i}", f"n{i + 1}", 30.0) for i in range(6)], columns=["component", "src", "dst", "weight"])
    near = spectra.shortest(spectra.both_directions(spark.createDataFrame(rows)), spark.createDataFrame([("c", "n0")], "component string, source string"), 60.0)
    assert sorted((r["node"], r["d"]) for r in near.collect()) == [("n0", 0.0), ("n1", 30.0), ("n2", 60.0)]
    some = spectra.betweenness(spark.createDataFrame(rows), pivots=3).toPandas()
    assert len(some) == 7 and (some["betweenness"] >= 0).all() and some["betweenness"].max() > 0
