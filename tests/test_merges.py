"""Merges lose nothing: nulls, late facts, several staged versions, open ends."""

import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import resolve, temporal


def dated(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.to_date(c) for c in df.columns if c.startswith("valid_")})


def chain(current, staged):
    """(value, from, to, current, action) of one key, by plain code."""
    rows = [(d, True, v) for v, d in current] + [(d, False, v) for d, v in {d: max((x for x, e in staged if e == d), key=lambda x: (x is not None, x)) for _, d in staged}.items()]
    rows.sort(key=lambda r: r[:2])
    kept = [r for i, r in enumerate(rows) if r[1] or i == 0 or rows[i - 1][2] != r[2]]
    kept = [r for i, r in enumerate(kept) if r[1] or i + 1 == len(kept) or not (kept[i + 1][1] and kept[i + 1][2] == r[2])]
    now = next((i for i, r in enumerate(kept) if r[1]), -1)
    last = len(kept) - 1
    return [(v, d, kept[i + 1][0] if i < last else None, i == last, ("kept" if i == last else "closed") if t else "late" if i < now else "inserted") for i, (d, t, v) in enumerate(kept)]


def test_versions_follow_each_other(spark):
    random.seed(3)
    day = lambda: f"2024-01-{random.randrange(1, 9):02}"
    current = {f"k{i}": [(random.choice([None, 1.0, 2.0]), day())] if i % 4 else [] for i in range(60)}
    staged = {k: [(random.choice([None, 1.0, 2.0, 3.0]), day()) for _ in range(random.randrange(6))] for k in current}
    flat = lambda rows: dated(spark, [(k, v, d) for k, some in rows.items() for v, d in some], "key string, value double, valid_from string")
    got = temporal.scd2_merge(flat(current), flat(staged)).collect()
    want = [(k, v, d, to, now, act) for k in current for v, d, to, now, act in chain(current[k], staged[k])]
    assert sorted(((r.key, r.value, str(r.valid_from), r.valid_to and str(r.valid_to), r.is_current, r.action) for r in got), key=repr) == sorted(want, key=repr)


def test_late_edges_keep_weight_and_day(spark):
    at = "key string, weight double, evidence array<string>, confidence double, valid_from string"
    now = dated(spark, [("a", 2.0, ["x"], 0.5, "2024-02-01")], at).withColumns({"valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    staged = dated(spark, [("a", 5.0, ["l"], 0.9, "2024-01-01"), ("a", 2.0, ["m"], 0.1, "2024-01-15"), ("a", 7.0, ["p"], 0.2, "2024-03-01"), ("a", None, None, 0.2, "2024-03-05"), ("a", 7.0, ["q"], 0.3, "2024-04-01"), ("a", 7.0, ["q"], 0.8, "2024-04-09")], at)
    got = [(r.weight, r.evidence, r.confidence, str(r.valid_from), str(r.valid_to), r.is_current) for r in temporal.supersede(now, staged).orderBy("valid_from").collect()]
    assert got == [
        (5.0, ["l"], 0.9, "2024-01-01", "2024-02-01", False), (2.0, ["m", "x"], 0.5, "2024-02-01", "2024-03-01", False), (7.0, ["p"], 0.2, "2024-03-01", "2024-03-05", False),
        (None, [], 0.2, "2024-03-05", "2024-04-01", False), (7.0, ["q"], 0.8, "2024-04-01", "None", True),
    ]


def test_null_contents_are_not_absent_rows(spark):
    make = lambda rows: spark.createDataFrame(rows, "k string, v string")
    got = temporal.change_feed(make([("a", None), ("b", "x"), ("c", None), ("d", "q"), (None, "n")]), make([("a", "y"), ("b", None), ("c", None), ("e", None), (None, "m")]), "k", "v").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([("a", None, "y", "update"), ("b", "x", None, "update"), ("d", "q", None, "delete"), ("e", None, None, "insert"), (None, "n", "m", "update")], key=repr)


@pytest.mark.parametrize("ends, want", [(["2024-01-05", "2024-02-01"], "2024-02-01"), (["2024-01-05", None], "None")])
def test_repointed_edges_hold_as_long_as_any_did(spark, ends, want):
    edges = dated(spark, [("p", "z", "X", 1.0, "2024-01-01", ends[0]), ("q", "z", "X", 2.0, "2023-01-01", ends[1])], "src string, dst string, edge_type string, weight double, valid_from string, valid_to string")
    row = resolve.repoint(edges, spark.createDataFrame([("q", "p")], "node_id string, canonical_id string")).collect()
    assert [(r.src, r.weight, str(r.valid_from), str(r.valid_to)) for r in row] == [("p", 3.0, "2023-01-01", want)]
