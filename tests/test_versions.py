"""Tables with versions, served copies, closures that follow their graph."""

import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import closures, graph
from lodestone.sources import sinks
from lodestone.sources.versions import Buckets, VersionedTable, sync, with_both_ends

KINDS = "id long, what string, tags map<string,string>"


def rows_of(df):
    return sorted((r.id, r.what, tuple(sorted((r.tags or {}).items()))) for r in df.collect())


def test_commits_are_differences_and_readers_open_later_files_alone(spark, tmp_path):
    held = VersionedTable(spark, f"file://{tmp_path}/t", "id", KINDS, 8)
    make = lambda rows: spark.createDataFrame(rows, KINDS)
    assert held.version() == -1 and held.changes_since(-1).count() == 0 and held.snapshot().count() == 0
    states = [[(1, "a", None), (2, None, {"x": "1"}), (3, "c", {})], [(1, "a", None), (2, "b", {"x": "1"}), (4, None, None), (None, "n", None)], [(1, "a", {"y": "2"}), (2, "b", {"x": "1"}), (4, None, None)]]
    for i, s in enumerate(states):
        assert held.commit(make(s)) == held.version() == i
        assert rows_of(held.snapshot()) == sorted((a, b, tuple(sorted((c or {}).items()))) for a, b, c in s if a is not None)
    assert held.commit(make(states[2])) == 2 == held.version()  # no difference, no version
    kinds = lambda v: sorted((r.version, r.id, r.change) for r in held.changes_since(v).collect())
    assert kinds(-1) == [(0, 1, "insert"), (0, 2, "insert"), (0, 3, "insert"), (1, 2, "update"), (1, 3, "delete"), (1, 4, "insert"), (2, 1, "update")]
    assert kinds(1) == [(2, 1, "update")] and kinds(2) == []
    assert {f.rpartition("/")[0].rpartition("/")[2] for f in held.changes_since(0).inputFiles()} == {"version=1", "version=2"}
    held.commit(make([(9, "part", None)]), whole=False)
    assert {r.id for r in held.snapshot().collect()} == {1, 2, 4, 9} and held.log().where("version = 3").first().touched == 1
    # a commit that was lost before its line of the log is not seen, and its number is taken again
    make([(77, "lost", None)]).withColumn("change", F.lit("insert")).write.parquet(f"file://{tmp_path}/t/changes/version=4")
    assert held.version() == 3 and held.changes_since(3).count() == 0
    again = VersionedTable(spark, f"file://{tmp_path}/t", "id", KINDS, 8)
    assert again.commit(make([(9, "new", None)]), whole=False) == 4 and [(r.id, r.what) for r in again.changes_since(3).collect()] == [(9, "new")]


def test_served_tables_rewrite_what_they_touch(spark, tmp_path):
    source = VersionedTable(spark, f"file://{tmp_path}/s", "id", KINDS, 8)
    served = Buckets(spark, f"file://{tmp_path}/d", "id", KINDS, 8)
    make = lambda rows: spark.createDataFrame([(i, w, None) for i, w in rows], KINDS)
    seen = lambda: sorted((r.id, r.what) for r in served.rows().collect())
    source.commit(make([(i, "hot" if i % 3 else "cold") for i in range(60)]))
    shown = F.col("what") != "cold"
    assert sync(source, served, "web", shown) == 8 and len(seen()) == 40 and source.watermark("web") == 0
    files = lambda: {p.name: {q.name for q in p.iterdir() if q.suffix == ".parquet"} for p in (tmp_path / "d").iterdir() if p.is_dir()}
    before = files()
    source.commit(make([(5, None)]), whole=False)
    assert sync(source, served, "web", shown, ("what",)) == 1 and (5, "hot") not in seen()  # a null content isn't shown
    assert sum(before[k] != v for k, v in files().items()) == 1
    source.commit(make([(5, "hot"), (7, "cold")]), whole=False)
    # the run is lost after its work and before its watermark: done again, by a new process, it changes nothing
    sync(source, served, "web", shown)
    once = seen()
    source.set_watermark("else", 5)
    other = Buckets(spark, f"file://{tmp_path}/d", "id", KINDS, 8)
    other.put(source.changes_since(0).groupBy("id").agg(F.max_by(F.struct("what", "tags"), "version").alias("c"), F.max("version").alias("version")).select("id", "c.*", F.col("c.what").eqNullSafe("hot").alias("live"), "version"))
    assert seen() == once and (5, "hot") in once and all(i != 7 for i, _ in once)
    assert sync(source, served, "web", shown) == 0
    source.commit(make([(1, "hot")]))  # all others go
    sync(source, served, "web", shown)
    assert seen() == [(1, "hot")] and served.rows(marks=True).count() == 60


def test_a_null_keeps_what_was_there(spark, tmp_path):
    served = Buckets(spark, f"file://{tmp_path}/k", "id", "id long, what string, vector array<float>", 4)
    put = lambda rows, keep=(): served.put(spark.createDataFrame([(*r, True, v) for *r, v in rows], "id long, what string, vector array<float>, live boolean, version long"), keep)
    put([(1, "a", [1.0], 0), (2, "b", None, 0)])
    put([(1, None, None, 1)], ("vector",))
    assert [(r.id, r.what, r.vector) for r in served.rows().orderBy("id").collect()] == [(1, None, [1.0]), (2, "b", None)]


def test_edges_wait_for_their_ends(spark):
    edges = spark.createDataFrame([("e1", "a", "b"), ("e2", "a", "z"), ("e3", None, "a")], "edge_id string, src string, dst string")
    able, waiting = with_both_ends(edges, spark.createDataFrame([("a",), ("b",)], "node_id string"))
    assert [r.edge_id for r in able.collect()] == ["e1"] and sorted(r.edge_id for r in waiting.collect()) == ["e2", "e3"]


@pytest.mark.parametrize("hops", [2, 3])
def test_closures_follow_random_edits(spark, hops):
    """Forty small graphs at once; in each some edges come, go or change."""
    random.seed(hops)
    old, new = [], []
    for g in range(40):
        links = {(random.choice("abcdefg"), random.choice("abcdefg"), random.choice("XY")): random.choice([1.0, 2.0, None]) for _ in range(random.randrange(3, 14))}
        after = dict(links)
        for _ in range(random.randrange(4)):
            if links and random.random() < 0.5:
                after.pop(random.choice(list(links)), None)
            else:
                after[random.choice("abcdefg"), random.choice("abcdefg"), random.choice("XY")] = random.choice([1.0, 3.0])
        name = lambda x, g=g: f"{g}{x}"
        for some, rows in ((links, old), (after, new)):
            rows += [(name(s), name(d), t, w) for (s, d, t), w in some.items()]
    make = lambda rows: spark.createDataFrame(rows, "src string, dst string, edge_type string, weight double")
    before = graph.closure(make(old), hops, types=True)
    told = lambda df: sorted(((r.src, r.dst, r.hops, r.weight, tuple(r.path), tuple(r.edge_types)) for r in df.collect()), key=repr)
    after = closures.updated(before, make(old), make(new), hops, types=True)
    want = told(graph.closure(make(new), hops, types=True))
    assert told(after) == want
    a, b = {x[:2]: x for x in told(before)}, {x[:2]: x for x in want}
    kinds = {(r.src, r.dst): r.change for r in closures.delta(before, after).collect()}
    assert kinds == {k: "insert" if k not in a else "delete" if k not in b else "update" for k in a.keys() | b.keys() if a.get(k) != b.get(k)}
    touched = {r.node_id for r in closures.affected(make(old), make(new), hops).collect()}
    assert {s for s, _ in kinds} <= touched and len(touched) < len({x[0] for x in old + new})


def test_snapshots_are_kept_by_number(spark, tmp_path):
    path = f"file://{tmp_path}/shots"
    for day in range(1, 6):
        sinks.replace_partitions(spark.createDataFrame([("a", f"2020-01-0{day}")], "src string, as_of string"), path, "as_of")
    assert sinks.keep_latest(spark, path, "as_of", 2) == ["2020-01-01", "2020-01-02", "2020-01-03"] and sinks.keep_latest(spark, path, "as_of", 2) == []
    assert spark.read.parquet(path).select(F.col("as_of").cast("string")).distinct().count() == 2
