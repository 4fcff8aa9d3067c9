"""The stored graph answers as the parts it is built of."""

from lodestone.operators import graph
from lodestone.operators.served import ServedGraph
from lodestone.sources import sinks


def test_served_answers(spark):
    edges = spark.createDataFrame([("a", "b", "X", 2.0), ("b", "c", "X", 3.0), ("a", "d", "X", 1.0), ("d", "h", "X", 1.0), ("h", "c", "X", 1.0)], "src string, dst string, edge_type string, weight double")
    nodes = spark.createDataFrame([(x, x.upper(), 3 if x == "h" else 0) for x in "abcdh"], "node_id string, name string, masking_tier int")
    docs = spark.createDataFrame([(1, "brook brook stone"), (2, "stone"), (3, None), (4, "moss")], "doc_id long, text string")
    mentions = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c")], "doc_id long, node_id string")
    g = ServedGraph.build(sinks.new_path(spark, "served"), nodes, edges, docs, mentions)
    got = sorted((r["src"], r["dst"], r["hops"]) for r in g.expand(["a", "none"]).collect())
    assert got == sorted((r["src"], r["dst"], r["hops"]) for r in graph.expand(graph.closure(edges, 2), spark.createDataFrame([("a",)], "node_id string"), nodes).collect()) == [("a", "b", 1), ("a", "c", 2), ("a", "d", 1)]
    assert g.expand([]).count() == 0

    rows = g.local(spark.createDataFrame([(1, "stone"), (2, "moss"), (3, "")], "query_id int, text string"), limit=50).collect()
    one = {(r["kind"], r["id"]): r["score"] for r in rows if r["query_id"] == 1}
    score = {r["doc_id"]: r["score"] for r in g.texts.search(spark.createDataFrame([(1, "stone")], "query_id int, text string")).collect()}
    assert set(score) == {1, 2}
    assert abs(one["chunk", "1"] - 1.05 * score[1]) < 2e-6 and abs(one["edge", "a>b"] - 0.4 - 0.1 * (score[1] + score[2])) < 2e-6
    assert abs(one["node", "a"] - 0.3 - 0.1 * score[1]) < 2e-6 and one["node", "c"] == 0.3 and ("edge", "d>h") not in one
    assert [(r["kind"], r["id"]) for r in rows if r["query_id"] == 2] == [("chunk", "4")] and not [r for r in rows if r["query_id"] == 3]

    asked = spark.createDataFrame([(1, "stone", "A", "C"), (2, "stone", "A", "nobody"), (3, None, None, "A"), (4, "moss", "a", "H"), (5, "moss", "C", "A"), (6, "", "B", "B")], "query_id long, text string, a string, b string")
    found = {}
    for r in g.paths(asked).collect():
        found.setdefault(r["query_id"], set()).add((r["kind"], r["id"]))
    # no row: no name and no text; both names known, but no way along the edges
    assert set(found) == {1, 2, 4, 6} and found[1] == {("path", "a>b>c")} and found[6] == {("path", "b")} and found[4] == {("chunk", "4")}
    assert found[2] >= {("chunk", "1"), ("edge", "a>b")}
    assert {r["id"] for r in g.paths(asked.where("query_id = 4"), tier=3).collect()} == {"a>d>h"}
    assert g.paths(asked.limit(0)).count() == 0


def test_expanding_needs_no_texts(spark):
    edges = spark.createDataFrame([("a", "b", "X", 2.0)], "src string, dst string, edge_type string, weight double")
    nodes = spark.createDataFrame([(x, x.upper(), 0) for x in "ab"], "node_id string, name string, masking_tier int")
    g = ServedGraph.build(sinks.new_path(spark, "served"), nodes, edges, None, spark.createDataFrame([(1, "a")], "doc_id long, node_id string"))
    assert [(r["src"], r["dst"]) for r in g.expand(["a"]).collect()] == [("a", "b")]
    g.add_texts(spark.createDataFrame([(1, "stone")], "doc_id long, text string"))
    assert {(r["kind"], r["id"]) for r in g.local(spark.createDataFrame([(1, "stone")], "query_id int, text string")).collect()} == {("chunk", "1"), ("edge", "a>b"), ("node", "a"), ("node", "b")}
