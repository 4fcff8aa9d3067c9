"""Queries: caches, neighbourhoods, evidence, gates and metrics as a caller asks for them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import node_id
from ..operators import extraction, gates, graph, retrieval, serving
from ..sources import builders, sinks
from .evidence import KNN, V, _payloads, _vectors
from .registry import GRAPH, NODES, query, sql_node_id, table
from .serving import FACTS, _facts
from .walks import DAY, HOLDS, SEEDS, _seeds

NOW = "2024-01-20"


@query(
    f"""WITH cache AS (SELECT user_id AS key, arg_max(value, event_id) AS value, max_by(ts, event_id) AS made_at, max(event_id) AS e FROM events WHERE ts < TIMESTAMP '{NOW}' GROUP BY 1),
live AS (SELECT key, value FROM cache WHERE made_at + to_days(CAST(e % 5 AS INTEGER)) > TIMESTAMP '{NOW}'), keys AS (SELECT DISTINCT user_id AS key FROM events),
made AS (SELECT user_id AS key, max(value) AS value FROM events WHERE user_id NOT IN (SELECT key FROM live) AND event_type <> 'error' GROUP BY 1)
SELECT key, coalesce(live.value, made.value) AS value, CASE WHEN live.key IS NOT NULL THEN 'held' WHEN made.key IS NOT NULL THEN 'made' ELSE 'none' END AS got FROM keys LEFT JOIN live USING (key) LEFT JOIN made USING (key)"""
)
def cache_read_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last event before a day is cached for some days; what is missing is worked out, and set: a second read finds it."""
    e, path = table(spark, sf_dir, "events"), sinks.new_path(spark, "cache")
    made_at = F.col("ts").cast("timestamp")
    expires = F.timestamp_add("DAY", (F.col("event_id") % 5).cast("int"), made_at)
    sinks.append(e.where(F.col("ts") < F.to_timestamp(F.lit(NOW))).select(F.col("user_id").alias("key"), "value", made_at.alias("made_at"), expires.alias("expires_at"), "event_id").groupBy("key").agg(F.max_by(F.struct("value", "made_at", "expires_at"), "event_id").alias("c")).select("key", "c.*"), path)
    work = lambda keys: e.where("event_type <> 'error'").withColumnRenamed("user_id", "key").join(keys, "key", "left_semi").groupBy("key").agg(F.max("value").alias("value"))
    keys = e.select(F.col("user_id").alias("key"))
    _, new = serving.read_through(spark.read.parquet(path), keys, work, NOW, 3)
    sinks.append(new, path)
    again, none = serving.read_through(spark.read.parquet(path), keys, lambda keys: keys.select("key", F.lit(None).cast("double").alias("value")), NOW, 3)
    got = F.when(F.col("made"), "made").when(F.col("none"), "none").otherwise("held")
    flag = lambda rows, name: rows.select("key", F.lit(True).alias(name))
    return again.join(flag(new, "made"), "key", "left").join(flag(none, "none"), "key", "left").select("key", "value", got.alias("got"))


@query(
    GRAPH + SEEDS + f""", near AS (SELECT * FROM edges WHERE edge_type IN ('EXPOSED_TO', 'FUNDS') AND {HOLDS} AND (src IN (SELECT node_id FROM seeds) OR dst IN (SELECT node_id FROM seeds)))
SELECT 'edge' AS kind, edge_id AS id, edge_type AS type FROM near UNION ALL SELECT 'entity', node_id, node_type FROM nodes WHERE node_id IN (SELECT src FROM near UNION SELECT dst FROM near)"""
)
def neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of two types in force on a day that touch the seeds, and the entities at their ends."""
    nodes = builders.nodes(spark, sf_dir)
    specs = tuple(s for s in builders.EDGES if s.edge_type in ("EXPOSED_TO", "FUNDS"))
    edges, ends = graph.neighbourhood(builders.edges(spark, sf_dir, specs), nodes, _seeds(nodes), ("EXPOSED_TO", "FUNDS"), DAY)
    one = edges.select(F.lit("edge").alias("kind"), F.col("edge_id").alias("id"), F.col("edge_type").alias("type"))
    return one.unionByName(ends.select(F.lit("entity").alias("kind"), F.col("node_id").alias("id"), F.col("node_type").alias("type")))


def _near(hops: int, start: str, types: str) -> str:
    """All edges in force, exposures of some weight only; entities of some types are entered alone."""
    return GRAPH + f""", held AS (SELECT src, dst FROM edges WHERE {HOLDS} AND (edge_type <> 'EXPOSED_TO' OR weight >= 50000)),
able AS (SELECT node_id FROM nodes WHERE node_type IN ({types})), pairs AS (SELECT src, dst FROM held WHERE dst IN (SELECT node_id FROM able) UNION SELECT dst, src FROM held WHERE src IN (SELECT node_id FROM able)),
reach AS (SELECT {start} AS node_id, 0 AS level UNION SELECT dst, level + 1 FROM reach JOIN pairs ON src = node_id WHERE level < {hops}), least AS (SELECT node_id, min(level) AS level FROM reach GROUP BY node_id)"""


def _reached(spark: SparkSession, sf_dir: str, kind: str, key: str, hops: int, types: tuple[str, ...]) -> DataFrame:
    edges = builders.edges(spark, sf_dir).where(graph.holds(DAY)).withColumn("materiality", F.when(F.col("edge_type") == "EXPOSED_TO", F.col("weight")))
    start = spark.range(1).select(node_id(F.lit(kind), F.lit(key)).alias("node_id"))
    among = builders.nodes(spark, sf_dir).where(F.col("node_type").isin(*types)).select("node_id")
    return graph.levels(serving.material(edges, 50_000.0), start, hops, among=among)


@query(_near(2, sql_node_id("LegalEntity", "'S1'"), "'Counterparty', 'LegalEntity'") + " SELECT node_id, level FROM least")
def expand_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ways over material edges of all types, in two hops, through companies and their counterparties only."""
    return _reached(spark, sf_dir, "LegalEntity", "S1", 2, ("Counterparty", "LegalEntity"))


@query(_near(5, sql_node_id("Product", "'P1'"), "'LegalEntity', 'Jurisdiction', 'Product'") + " SELECT level, node_type, count(*) AS n FROM least JOIN nodes USING (node_id) GROUP BY 1, 2")
def dependencies_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a product hangs together with in five hops, counterparties left out."""
    near = _reached(spark, sf_dir, "Product", "P1", 5, ("LegalEntity", "Jurisdiction", "Product"))
    return near.join(builders.nodes(spark, sf_dir).select("node_id", "node_type"), "node_id").groupBy("level", "node_type").agg(F.count("*").alias("n"))


@query(FACTS + " SELECT relationship_id, evidence_id, source_uri FROM e WHERE target_name IN (SELECT n_name FROM nation WHERE n_regionkey = 1)")
def get_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All evidence of the relationships that lead into one region."""
    facts = _facts(spark, sf_dir)
    wanted = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_name").alias("target_name"))
    _, relationships, evidence = serving.compile_facts(facts)
    _, asked, _ = serving.compile_facts(facts.join(wanted, "target_name", "left_semi"))
    return serving.evidence_of(evidence, asked).join(relationships.select("relationship_id"), "relationship_id", "left_semi").select("relationship_id", "evidence_id", "source_uri")


#: Rejects of the events of the last seven days; products without a vector of their number.
GATES = """WITH a AS (SELECT ts, CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_type = 'error' THEN 1 ELSE 2 END AS n, CASE WHEN event_id % 11 <> 0 AND event_type NOT IN ('error', 'click', 'view') THEN 1 ELSE 0 END AS e,
  CASE WHEN event_id % 11 = 0 THEN 1 WHEN event_type = 'error' THEN 2 WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS r FROM events),
g AS (SELECT 'rejected in a hundred' AS gate, (SELECT 100.0::DOUBLE * sum(r) / greatest(sum(n + e + r), 1) FROM a WHERE ts > (SELECT max(ts) FROM a) - INTERVAL 7 DAY) AS value, 15.0::DOUBLE AS limit_
  UNION ALL SELECT 'hot nodes without a vector', (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT vec_id FROM embeddings))::DOUBLE, 1000.0::DOUBLE)
SELECT gate, round(value, 9) AS value, limit_ AS "limit", value <= limit_ AS passed FROM g"""


@query(GATES)
def gate_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = extraction.parse(_payloads(spark, sf_dir))[2].join(table(spark, sf_dir, "events").select(F.concat(F.lit("c_"), "event_id").alias("chunk_id"), "ts"), "chunk_id")
    hot = builders.nodes(spark, sf_dir).where("node_type = 'Product'")
    held = table(spark, sf_dir, "embeddings").select(node_id(F.lit("Product"), F.concat(F.lit("P"), "vec_id")).alias("node_id"))
    made = gates.report([gates.gate("rejected in a hundred", gates.rejected_share(audit, "ts"), 15), gates.gate("hot nodes without a vector", hot.join(held, "node_id", "left_anti"), 1000)])
    return made.withColumn("value", F.round("value", 9))


@query(
    f"""WITH found AS ({KNN.format(where=' AND v.vec_id <> q.vec_id')}), h AS (SELECT query_id, sum(1 / log2(rank + 1.0::DOUBLE)) AS got FROM found JOIN embeddings q ON q.vec_id = query_id JOIN embeddings e ON e.vec_id = found.vec_id WHERE q.label = e.label GROUP BY 1),
t AS (SELECT q.vec_id AS query_id, least(10, (SELECT count(*) - 1 FROM embeddings e WHERE e.label = q.label)) AS n FROM embeddings q WHERE vec_id % 20 = 0)
SELECT query_id, round(coalesce(got, 0) / (SELECT sum(1 / log2(i + 1.0::DOUBLE)) FROM generate_series(1, 10) s(i) WHERE i <= n), 9) AS ndcg FROM t LEFT JOIN h USING (query_id) WHERE n > 0"""
)
def ndcg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well vectors find those of their own label, the order of ten counted."""
    v = _vectors(spark, sf_dir)
    q = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql"), F.col("embedding").alias("query"))
    near = retrieval.knn(v, q.select("query_id", "query"), 10, own=False).join(v.select("vec_id", "label"), "vec_id").join(q.drop("query"), "query_id").where("label = ql")
    sizes = v.groupBy(F.col("label").alias("ql")).agg((F.count("*") - 1).alias("total")).where("total > 0")
    return gates.ndcg_of(q.join(sizes, "ql").select("query_id", "total"), near.select("query_id", "rank"), 10).withColumn("ndcg", F.round("ndcg", 9))


@query(FACTS + " SELECT count(DISTINCT relationship_id) FILTER (WHERE section <> 's0')::DOUBLE / count(DISTINCT relationship_id) AS coverage FROM e")
def evidence_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many relationships have evidence outside the first section."""
    _, relationships, evidence = serving.compile_facts(_facts(spark, sf_dir))
    return gates.evidence_coverage(relationships, evidence.where("section <> 's0'"))


#: A question for each nation, of a kind by its region.
QUESTIONS = "CASE n_regionkey WHEN 0 THEN 'What is ' || n_name || ' computed from?' WHEN 1 THEN 'How is ' || n_name || ' tied to FRANCE' WHEN 2 THEN 'Overview  of ' || n_name WHEN 3 THEN 'An overview of the patterns that one sees when looking at all the suppliers in ' || n_name || ' today' ELSE 'Who sells in ' || n_name END"


@query(f"SELECT n_nationkey AS query_id, CASE n_regionkey WHEN 0 THEN 'lineage' WHEN 1 THEN 'path' WHEN 2 THEN 'global' WHEN 3 THEN 'drift' ELSE 'local' END AS mode FROM nation WHERE {QUESTIONS} IS NOT NULL")
def pick_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.modes(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("query_id"), F.expr(QUESTIONS).alias("text")))


@query(GRAPH + " SELECT edge_id, s.name || ' -[' || edge_type || ']-> ' || d.name AS text FROM edges JOIN nodes s ON s.node_id = src JOIN nodes d ON d.node_id = dst")
def edge_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.edge_text(builders.edges(spark, sf_dir, plain=True), builders.nodes(spark, sf_dir, plain=True), builders.with_ids)


@query(f"WITH {V} SELECT vec_id, label FROM v WHERE label % 4 = 0 OR (label % 4 = 1 AND vec_id % 7 = 3) OR (label % 4 = 2 AND tier = 2)")
def memory_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are scopes: of all, of users, of agents (every second note is for one of them), of teams."""
    scope = F.element_at(F.array(*map(F.lit, ("global", "user", "agent", "team"))), (F.col("label") % 4 + 1).cast("int"))
    notes = _vectors(spark, sf_dir).withColumns({"scope": scope, "user_id": F.col("vec_id") % 7, "agent_id": F.col("tier").cast("string")})
    return serving.scoped(notes, 3, 2).select("vec_id", "label")


@query("SELECT c_custkey AS id, c_mktsegment AS segment, NULL::BIGINT AS orders FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT o_custkey, NULL, count(*) FROM orders GROUP BY 1")
def upsert_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a column that the table didn't have take the place of those with their keys."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return sinks.replaced(old, table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("orders")), "id")


@query(
    NODES + """, h AS (SELECT 'node' AS kind, node_id AS id, 1.0::DOUBLE / (1 + length(name)) AS score, confidence, node_type FROM nodes WHERE node_type IN ('Jurisdiction', 'LegalEntity'))
SELECT kind, id, round(CASE WHEN node_type = 'Jurisdiction' THEN 0.5::DOUBLE * score + 0.5::DOUBLE * confidence ELSE score END, 6) AS score FROM h ORDER BY score DESC, kind, id LIMIT 60"""
)
def reranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second ranker knows jurisdictions alone; its scores are mixed in by halves."""
    nodes = builders.nodes(spark, sf_dir).where("node_type IN ('Jurisdiction', 'LegalEntity')")
    hits = nodes.select(F.lit("node").alias("kind"), F.col("node_id").alias("id"), (1.0 / (1 + F.length("name"))).alias("score"))
    return retrieval.blended(hits, nodes.where("node_type = 'Jurisdiction'").select(F.lit("node").alias("kind"), F.col("node_id").alias("id"), F.col("confidence").alias("score")))
