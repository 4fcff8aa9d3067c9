"""What callers ask for, on odd rows."""

import math
import unicodedata

import pytest
from pyspark.sql import functions as F

from lodestone.functions.text import ascii_of, blocking_key
from lodestone.operators import gates, graph, retrieval, serving
from lodestone.sources import sinks

NAMES = ["Ångström & Söhne", "ﬁrst Ｗｉｄｅ ℌ ½", "Straße", "日本 Bank", "", "plain", "été", "№ 5 ™"]


def test_names_decompose(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES] + [(None,)], "name string").select("name", ascii_of(F.col("name")).alias("got")).collect()
    assert {r["name"]: r["got"] for r in rows} == {n: unicodedata.normalize("NFKD", n).encode("ascii", "ignore").decode() for n in NAMES} | {None: None}


def test_blocks_fall_back(spark):
    rows = spark.createDataFrame([("a", "us", "fr"), (None, None, "fr"), (None, None, None), ("c", "", "fr")], "x string, country string, place string")
    got = [r[0] for r in rows.select(blocking_key(F.lit("T"), F.col("country"), F.lit("Quercus AG"), F.col("place"))).collect()]
    assert got == ["T|US|quer", "T|FR|quer", "T||quer", "T|FR|quer"]


def test_cache_entries(spark):
    rows = [("a", 1.0, "2024-01-01", None), ("a", 2.0, "2024-01-02", "2024-01-03"), ("b", 3.0, "2024-01-01", None), ("b", 4.0, "2024-01-02", "2024-02-01"), ("c", None, "2024-01-01", None)]
    cache = spark.createDataFrame(rows, "key string, value double, m string, e string").select("key", "value", F.to_timestamp("m").alias("made_at"), F.to_timestamp("e").alias("expires_at"))
    asked = []

    def make(keys):
        asked.extend(r["key"] for r in keys.collect())
        return keys.where("key = 'a'").withColumn("value", F.lit(9.0))

    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("a",)], "key string")
    values, new = serving.read_through(cache, wanted, make, "2024-01-05", 2)
    assert {r["key"]: r["value"] for r in values.collect()} == {"a": 9.0, "b": 4.0, "c": None, "d": None} and sorted(asked) == ["a", "d"]  # an expired entry hides older ones
    assert [(r["key"], r["expires_at"].day) for r in new.collect()] == [("a", 7)]


def test_modes_of_a_table(spark):
    said = ["Where does it come from", "what came  from here", "Overview please", "an overview " + "word " * 20, "is there a route from A to B", "", "who?", "depends on between"]
    rows = retrieval.modes(spark.createDataFrame(list(enumerate(said)) + [(99, None)], "query_id int, text string")).collect()
    assert {r["query_id"]: r["mode"] for r in rows} == {i: retrieval.pick_mode(t) for i, t in enumerate(said)} | {99: "local"}


def test_levels_enter_some_nodes_only(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "a"), ("d", "e")], "src string, dst string")
    among, seeds = spark.createDataFrame([("b",), ("c",), ("e",)], "node_id string"), spark.createDataFrame([("a",)], "node_id string")
    assert {(r["node_id"], r["level"]) for r in graph.levels(edges, seeds, 3, among=among).collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_neighbourhood_of_a_day(spark):
    rows = [("e1", "a", "b", "X", "2024-01-01", "2024-02-01"), ("e2", "c", "a", "X", None, None), ("e3", "a", "a", "X", None, None), ("e4", "a", "d", "Y", None, None), ("e5", "b", "c", "X", None, None)]
    edges = spark.createDataFrame(rows, "edge_id string, src string, dst string, edge_type string, f string, t string").withColumns({"valid_from": F.to_date("f"), "valid_to": F.to_date("t")})
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "node_id string")
    near, ends = graph.neighbourhood(edges, nodes, nodes.where("node_id = 'a'"), ("X",), "2024-02-01")
    assert sorted(r["edge_id"] for r in near.collect()) == ["e2", "e3"] and sorted(r["node_id"] for r in ends.collect()) == ["a", "c"]


def test_orders_and_coverage(spark):
    totals = spark.createDataFrame([(1, 2), (2, 1), (3, 9)], "query_id int, total int")
    hits = spark.createDataFrame([(1, 1), (1, 3), (2, 5)], "query_id int, rank int")
    got = {r["query_id"]: r["ndcg"] for r in gates.ndcg_of(totals, hits, 4).collect()}
    assert got == {1: pytest.approx((1 + 0.5) / (1 + 1 / math.log2(3))), 2: 0.0, 3: 0.0}
    ids = spark.createDataFrame([("r1",), ("r2",)], "relationship_id string")
    assert gates.evidence_coverage(ids, ids.where("relationship_id = 'r1'")).first()[0] == 0.5 and gates.evidence_coverage(ids.limit(0), ids).first()[0] == 1.0


def test_rerank_and_new_columns(spark):
    hits = spark.createDataFrame([("node", "a", 0.4), ("node", "b", 0.6)], "kind string, id string, score double")
    assert [(r["id"], r["score"]) for r in retrieval.blended(hits, hits.where("id = 'a'").withColumn("score", F.lit(1.0))).collect()] == [("a", 0.7), ("b", 0.6)]
    old, new = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string"), spark.createDataFrame([(2, 5), (3, 6)], "id int, n int")
    assert sorted(tuple(r) for r in sinks.replaced(old, new, "id").collect()) == [(1, "x", None), (2, None, 5), (3, None, 6)]


def test_scopes(spark):
    rows = [(1, "global", None, None), (2, "user", 3, None), (3, "user", 4, None), (4, "agent", None, "*"), (5, "agent", None, "z"), (6, "team", 3, "q"), (7, None, 3, "q"), (8, "agent", None, "q")]
    notes = spark.createDataFrame(rows, "note int, scope string, user_id int, agent_id string")
    assert sorted(r["note"] for r in serving.scoped(notes, 3, "q").collect()) == [1, 2, 4, 8]
