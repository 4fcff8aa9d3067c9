"""Queries: sinks, served tables, entities, evidence packages, caches, chunk filters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import render
from ..functions.vectors import cosine
from ..operators import extraction, graph, retrieval, serving, temporal
from ..operators.retrieval import top
from ..sources import builders, sinks
from .core import HOLDS, _versions
from .evidence import BM25, V, _lexical, _vectors
from .registry import GRAPH, NODES, VERSIONS, query, table
from .walks import SEEDS, WALK, _hot_from, _seeds


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'extract' ELSE 'index' END AS work FROM documents WHERE doc_id % 3 = 0 OR doc_id % 5 = 0")
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents never extracted, and those changed since they were indexed."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.lit(1)).alias("extracted_at"), F.when(F.col("doc_id") % 7 != 0, F.lit(5)).alias("indexed_at"), F.when(F.col("doc_id") % 5 == 0, F.lit(9)).otherwise(F.lit(1)).alias("updated_at"))
    new = d.where("extracted_at IS NULL").select("doc_id", F.lit("extract").alias("work"))
    old = d.where("extracted_at IS NOT NULL AND updated_at > coalesce(indexed_at, 5)").select("doc_id", F.lit("index").alias("work"))
    return new.unionByName(old)


FACTS = """WITH facts AS (SELECT s_name AS source_name, 'LegalEntity' AS source_type, 'uri:' || s_suppkey AS source_uri, 'LOCATED_IN' AS relationship_type, n_name AS target_name, 'Jurisdiction' AS target_type, 's' || (s_suppkey % 3) AS section FROM supplier JOIN nation ON s_nationkey = n_nationkey),
f AS (SELECT *, 'ent_' || substr(sha256(lower(source_name)), 1, 24) AS source_id, 'ent_' || substr(sha256(lower(target_name)), 1, 24) AS target_id FROM facts),
r AS (SELECT *, 'rel_' || substr(sha256(lower(source_id || '|' || relationship_type || '|' || target_id)), 1, 24) AS relationship_id FROM f),
e AS (SELECT *, 'ev_' || substr(sha256(lower(relationship_id || '|' || source_uri || '|' || section)), 1, 24) AS evidence_id FROM r)"""


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(F.col("s_name").alias("source_name"), F.lit("LegalEntity").alias("source_type"), F.concat(F.lit("uri:"), "s_suppkey").alias("source_uri"), F.lit("LOCATED_IN").alias("relationship_type"), F.col("n_name").alias("target_name"), F.lit("Jurisdiction").alias("target_type"), F.concat(F.lit("s"), F.col("s_suppkey") % 3).alias("section"))


@query(FACTS + " SELECT 'entity' AS kind, id FROM (SELECT source_id AS id FROM e UNION SELECT target_id FROM e) UNION ALL SELECT DISTINCT 'relationship', relationship_id FROM e UNION ALL SELECT DISTINCT 'evidence', evidence_id FROM e")
def compile_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities, relationships, evidence = serving.compile_facts(_facts(spark, sf_dir))
    one = lambda df, kind, c: df.select(F.lit(kind).alias("kind"), F.col(c).alias("id"))
    return one(entities, "entity", "entity_id").unionByName(one(relationships, "relationship", "relationship_id")).unionByName(one(evidence, "evidence", "evidence_id"))


@query(FACTS + ", x AS (SELECT relationship_id, evidence_id, source_uri, section FROM e WHERE CAST(substr(source_uri, 5) AS INTEGER) % 4 <> 0) SELECT relationship_id, evidence_id, source_uri, section FROM x ORDER BY relationship_id, evidence_id LIMIT 20")
def evidence_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved evidence within a budget of twenty."""
    _, relationships, evidence = serving.compile_facts(_facts(spark, sf_dir))
    evidence = evidence.withColumn("approved", F.substring("source_uri", 5, 9).cast("int") % 4 != 0).drop("relationship_id")
    chosen, _ = serving.package(relationships.withColumn("confidence", F.lit(1.0)), evidence, relationships)
    return chosen.select("relationship_id", "evidence_id", "source_uri", "section")


@query(FACTS + ", x AS (SELECT relationship_id FROM e GROUP BY 1 HAVING bool_and(CAST(substr(source_uri, 5) AS INTEGER) % 4 = 0)) SELECT 'relationships without evidence' AS warning, count(*) AS n FROM x HAVING count(*) > 0 UNION ALL SELECT 'no text hits', 1")
def evidence_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, relationships, evidence = serving.compile_facts(_facts(spark, sf_dir))
    evidence = evidence.withColumn("approved", F.substring("source_uri", 5, 9).cast("int") % 4 != 0).drop("relationship_id")
    return serving.package(relationships.withColumn("confidence", F.lit(1.0)), evidence, relationships.limit(0))[1]


@query(VERSIONS + f" SELECT '2024-01-05' AS as_of, count(*) AS n, sum(event_id)::BIGINT AS ids FROM versions WHERE {HOLDS.format(d='2024-01-05')} UNION ALL SELECT '2024-01-12', count(*), sum(event_id)::BIGINT FROM versions WHERE {HOLDS.format(d='2024-01-12')} AND event_id % 2 = 0")
def snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots by date; writing one of them again replaces that one only."""
    versions, path = _versions(spark, sf_dir), sinks.new_path(spark, "snapshots")
    day = lambda d: temporal.as_of(versions, d).select("event_id", F.lit(d).alias("as_of"))
    sinks.replace_partitions(day("2024-01-05").unionByName(day("2024-01-12")), path, "as_of")
    sinks.replace_partitions(day("2024-01-12").where("event_id % 2 = 0"), path, "as_of")
    rows = spark.read.option("recursiveFileLookup", "false").parquet(path)
    return rows.groupBy(F.col("as_of").cast("string").alias("as_of")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN upper(c_mktsegment) || '!' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 4 <> 0 THEN -1.0::DOUBLE ELSE c_acctbal END AS balance FROM customer")
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows are updated; a null balance leaves the old one."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    new = old.where("id % 2 = 0").select("id", F.concat(F.upper("segment"), F.lit("!")).alias("segment"), F.when(F.col("id") % 4 != 0, F.lit(-1.0)).alias("balance"))
    return sinks.merged(old, new, "id", ("balance",))


@query("SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id HAVING arg_max(event_type, event_id) <> 'error' UNION ALL SELECT 1000000 + n_nationkey, 0.0::DOUBLE FROM nation")
def sync_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A served table takes in a change log in which the last change of some keys closes them."""
    log = table(spark, sf_dir, "events").select("user_id", "value", "event_id", (F.col("event_type") != "error").alias("is_current"))
    old = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1_000_000).cast("long").alias("user_id"), F.lit(0.0).alias("value")).unionByName(log.groupBy("user_id").agg(F.min("value").alias("value")))
    return sinks.served(log, old, "user_id", "event_id")


@query(GRAPH + ", served AS (SELECT node_id FROM nodes WHERE node_type IN ('LegalEntity', 'Jurisdiction')) SELECT edge_id, src, dst FROM edges WHERE src IN (SELECT node_id FROM served) AND dst IN (SELECT node_id FROM served)")
def sync_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = builders.nodes(spark, sf_dir).where("node_type IN ('LegalEntity', 'Jurisdiction')").select("node_id")
    return graph.induced(builders.edges(spark, sf_dir), served).select("edge_id", "src", "dst")


@query("SELECT DISTINCT user_id, event_type FROM events")
def evidence_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    old = e.where("event_id % 2 = 0").select("user_id", "event_type").distinct()
    return sinks.added(old, e.select("user_id", "event_type"), "user_id", "event_type")


@query(NODES + " SELECT node_id, name FROM nodes WHERE contains(lower(name), 'nation_1') ORDER BY name, node_id LIMIT 20")
def find_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.find_entities(builders.nodes(spark, sf_dir), "NATION_1").select("node_id", "name")


@query(GRAPH + " SELECT edge_id FROM edges WHERE edge_type <> 'EXPOSED_TO' OR weight >= 50000")
def materiality_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = builders.edges(spark, sf_dir).withColumn("materiality", F.when(F.col("edge_type") == "EXPOSED_TO", F.col("weight")))
    return serving.material(edges, 50_000.0).select("edge_id")


@query("SELECT doc_id FROM documents WHERE doc_id % 3 <> 1 AND doc_id % 4 <> 2 AND doc_id % 5 IN (0, 2)")
def chunk_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In force on a day (missing dates are no bounds), about some entities, as far as an open caller may see."""
    d = table(spark, sf_dir, "documents").select("doc_id")
    d = d.withColumns({"effective_date": F.when(F.col("doc_id") % 3 == 1, F.lit("2030-01-01")).otherwise(F.lit(None)).cast("date"), "valid_to": F.when(F.col("doc_id") % 4 == 2, F.lit("2020-01-01")).otherwise(F.lit(None)).cast("date")})
    d = d.withColumns({"entity_ids": F.array(F.concat(F.lit("e"), F.col("doc_id") % 5)), "masking_tier": F.lit(0)})
    return serving.redact(serving.about(serving.in_force(d, "2024-01-01"), ["e0", "e2"]), serving.caller_tier(["guest", "reader"], {"reader": 1, "editor": 2})).select("doc_id")


@query(WALK.replace("0.0::DOUBLE AS total_weight", "1.0::DOUBLE AS total_weight").replace("total_weight + weight", "total_weight * weight") + " SELECT seed, node, hops, total_weight AS weight, path FROM walk WHERE hops BETWEEN 1 AND 3 ORDER BY hops, weight DESC, path LIMIT 500")
def deep_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walks with the product of their weights."""
    seeds = _seeds(builders.nodes(spark, sf_dir))
    edges, nodes = _hot_from(spark, sf_dir, seeds, 3)
    walks = graph.traverse(edges, seeds, nodes, 3, 3, None, 500, product=True)
    return walks.select("seed", "node", "hops", F.col("total_weight").alias("weight"), F.array_join("path", ">").alias("path"))


@query(NODES + " SELECT node_id, name || ' (' || node_type || ')' || CASE WHEN properties = '' THEN '' ELSE ': ' || replace(properties, ';', '; ') END AS text FROM nodes")
def node_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = builders.nodes(spark, sf_dir)
    assert "properties" in nodes.columns
    return nodes.select("node_id", serving.node_text(nodes).alias("text"))


def _letters() -> Callable[[list[str]], list[list[float]]]:
    """Stands for an embedding model: how long a text is and how many blanks it has."""
    return lambda texts: [[float(len(t)), float(t.count(" "))] for t in texts]


@query(NODES + " SELECT node_id, CASE WHEN source_system = 'region' THEN '0.0|0.0' ELSE format('{:.1f}|{:.1f}', length(name)::DOUBLE, (length(name) - length(replace(name, ' ', '')))::DOUBLE) END AS embedding FROM nodes")
def embed_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = builders.nodes(spark, sf_dir).select("node_id", F.col("name").alias("text"), F.when(F.col("source_system") == "region", F.array(F.lit(0.0), F.lit(0.0))).alias("embedding"))
    return serving.embed_missing(rows, _letters).select("node_id", F.array_join(F.transform("embedding", lambda x: x.cast("string")), "|").alias("embedding"))


@query("SELECT 'v_' || vec_id AS node_id, 'a' || label AS l0, 'b' || (label % 3) AS l1, CASE WHEN label % 2 = 0 THEN 'c' END AS l2 FROM embeddings")
def community_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir).select(F.concat(F.lit("v_"), "vec_id").alias("node_id"), "label")
    level = lambda n, c, rows=v: rows.select("node_id", F.lit(n).alias("level"), c.alias("community_id"))
    labels = level(0, F.concat(F.lit("a"), "label")).unionByName(level(1, F.concat(F.lit("b"), F.col("label") % 3))).unionByName(level(2, F.lit("c"), v.where("label % 2 = 0")))
    return serving.levels_to_columns(labels)


@query(f"WITH {V}, q AS (SELECT e FROM v WHERE vec_id = 1) SELECT vec_id, label, round(list_cosine_similarity(v.e, q.e), 6) AS score FROM v, q WHERE tier <= 1 AND label % 2 = 0 ORDER BY score DESC, vec_id LIMIT 6")
def search_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    q = v.where("vec_id = 1").select(F.col("embedding").alias("q"))  # one row
    rows = v.where("tier <= 1 AND label % 2 = 0").crossJoin(F.broadcast(q)).select("vec_id", "label", F.round(cosine(F.col("embedding"), F.col("q")), 6).alias("score"))
    return top(rows, "score", 6, None, "vec_id")


@query(f"WITH {BM25}, s AS (SELECT query_id, source, max(score) AS score FROM lex JOIN documents USING (doc_id) WHERE doc_id % 2 = 0 GROUP BY ALL) SELECT query_id, source, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, source) AS rank FROM s) WHERE rank <= 3")
def search_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by their best text hit, of one level (even ids) only."""
    docs = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select("doc_id", "source")
    rows = _lexical(spark, sf_dir).join(docs, "doc_id").groupBy("query_id", "source").agg(F.max("score").alias("score"))
    return top(rows, "score", 3, "query_id", "source")


#: Two fields: texts count double, sources once; the better one counts; fused with the vectors' order by 1 / (20 + rank) over windows of 60.
@query(
    f"WITH {BM25}, {V}, f AS (SELECT doc_id, greatest(2 * score, CASE WHEN source = 'src1' THEN 1.0::DOUBLE ELSE 0 END) AS s FROM lex JOIN documents USING (doc_id) WHERE query_id = 0), a AS (SELECT doc_id, row_number() OVER (ORDER BY round(s, 6) DESC, doc_id) AS rank FROM f),"
    " b AS (SELECT v.vec_id AS doc_id, row_number() OVER (ORDER BY round(list_cosine_similarity(v.e, q.e), 6) DESC, v.vec_id) AS rank FROM v, (SELECT e FROM v WHERE vec_id = 2) q)"
    " SELECT doc_id, round(sum(1.0::DOUBLE / (20 + rank)), 9) AS score FROM (SELECT doc_id, rank FROM a WHERE rank <= 60 UNION ALL SELECT doc_id, rank FROM b WHERE rank <= 60) GROUP BY doc_id"
)
def hybrid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    best = F.greatest(2 * F.col("score"), F.when(F.col("source") == "src1", 1.0).otherwise(0.0))
    lex = _lexical(spark, sf_dir).where("query_id = 0").join(docs, "doc_id").select("query_id", "doc_id", F.round(best, 6).alias("s"))
    v = _vectors(spark, sf_dir)
    q = v.where("vec_id = 2").select(F.col("embedding").alias("q"))  # one row
    near = v.crossJoin(F.broadcast(q)).select(F.lit(0).cast("long").alias("query_id"), F.col("vec_id").alias("doc_id"), F.round(cosine(F.col("embedding"), F.col("q")), 6).alias("s"))
    fused = retrieval.rrf([top(lex, "s", 60), top(near, "s", 60)], 20)
    return fused.select("doc_id", F.round("score", 9).alias("score"))


@query("SELECT count(*) AS n FROM (SELECT max_by(ts, event_id) AS ts, max(event_id) AS e FROM events GROUP BY user_id) WHERE ts + to_days(CAST(e % 5 AS INTEGER)) <= TIMESTAMP '2024-01-31'")
def cache_gc(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by(F.struct("event_id", "ts"), "event_id").alias("e")).select("user_id", "e.*")
    return serving.cleared(last.withColumn("expires_at", F.timestamp_add("DAY", (F.col("event_id") % 5).cast("int"), F.col("ts")).cast("timestamp")), "2024-01-31")[1]


@query(GRAPH + SEEDS + " SELECT node_id, node_type FROM nodes WHERE node_id NOT IN (SELECT src FROM edges) AND node_id NOT IN (SELECT dst FROM edges)")
def quality_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges, nodes = builders.edges(spark, sf_dir), builders.nodes(spark, sf_dir)
    ends = edges.select(F.col("src").alias("node_id")).unionByName(edges.select(F.col("dst").alias("node_id"))).distinct()
    return nodes.join(ends, "node_id", "left_anti").select("node_id", "node_type")


@query()
def chunk_udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunker as a table function in SQL."""
    from pyspark.sql.functions import udtf

    @udtf(returnType="ordinal int, section string, text string")
    class ChunkText:
        def eval(self, text: str):  # noqa: ANN201  yields rows
            for i, (section, part) in enumerate(extraction.chunk_text(text)):
                yield i, section, part

    spark.udtf.register("chunk_text", ChunkText)
    table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("whole")).createOrReplaceTempView("chunk_input")
    return spark.sql("SELECT doc_id, c.ordinal, c.section, c.text FROM chunk_input, LATERAL chunk_text(whole) c")


@query(NODES + " SELECT node_type, properties, count(*) AS n FROM nodes WHERE source_system = 'nation' GROUP BY ALL")
def property_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builders.nodes(spark, sf_dir).where("source_system = 'nation'").groupBy("node_type", render(F.col("properties")).alias("properties")).agg(F.count("*").alias("n"))
