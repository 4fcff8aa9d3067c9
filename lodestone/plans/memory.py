"""Queries: what is kept between questions and runs: snapshots of closures, memories, logs, indexes, links, summaries."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import content_hash, node_id
from ..functions.text import capitalised
from ..operators import extraction, graph, resolve, retrieval, serving
from ..operators.ontology import RULES
from ..sources import builders, sinks
from .evidence import ASKED, BM25, KNN, TERMS, V, _lexical, _payloads, _vectors
from .people import FEEDS, _feeds
from .registry import GRAPH, NODES, query, sql_node_id, table
from .walks import AROUND, HOLDS, _structure

DAYS = ("1996-01-01", "1998-01-01")
KINDS = ("Product", "LegalEntity", "Counterparty")


@query(
    GRAPH + f""", held AS (SELECT src, dst, edge_type, weight FROM edges WHERE {HOLDS} AND edge_type IN ('EXPOSED_TO', 'FUNDS')),
seeds AS (SELECT node_id FROM nodes WHERE canonical_key IN ('P1', 'P2', 'P3') AND node_type = 'Product'),
one AS (SELECT src, dst, 1 AS hops, weight, src || '>' || dst AS path, edge_type AS edge_types FROM held WHERE src IN (SELECT node_id FROM seeds)),
two AS (SELECT o.src, h.dst, 2 AS hops, o.weight * h.weight AS weight, o.path || '>' || h.dst AS path, 'EXPOSED_TO,FUNDS' AS edge_types FROM one o JOIN held h ON h.src = o.dst),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY hops, weight DESC, path) AS rn FROM (SELECT * FROM one UNION ALL SELECT * FROM two)) WHERE rn = 1)
SELECT src, dst, hops, weight, path, edge_types FROM best WHERE edge_types LIKE '%EXPOSED_TO%' ORDER BY hops, weight DESC, src, dst LIMIT 200"""
)
def expand_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closures of two days lie beside each other; the latest answers, with paths that hold an exposure."""
    nodes = builders.nodes(spark, sf_dir)
    specs = tuple(s for s in builders.EDGES if s.edge_type in ("EXPOSED_TO", "FUNDS"))
    edges, path = builders.edges(spark, sf_dir, specs), sinks.new_path(spark, "closures")
    seeds = nodes.where(F.col("canonical_key").isin("P1", "P2", "P3") & (F.col("node_type") == "Product")).select("node_id")
    for day in DAYS:
        closed = graph.closure(graph.hot_edges(edges, nodes, KINDS, 1_000_000, day), 2, seeds, types=True)
        sinks.replace_snapshot(closed, path, "as_of", day)
    latest = sinks.snapshots(spark, path, "as_of")[-1]  # nobody may be exposed on that day
    found = graph.expand_snapshot(spark.read.parquet(path), seeds, nodes, 2, latest, ["EXPOSED_TO"], 2)
    return found.select("src", "dst", "hops", "weight", F.array_join("path", ">").alias("path"), F.array_join("edge_types", ",").alias("edge_types"))


A, B = (sql_node_id("Jurisdiction", f"'{k}'") for k in ("N0", "N5"))


@query(
    AROUND.format(start=A, hops=0) + f""", walk AS (SELECT {A} AS node, 0 AS hops, {A} AS path
  UNION ALL SELECT dst, hops + 1, path || '>' || dst FROM walk JOIN pairs ON src = node WHERE hops < 3 AND strpos(path, dst) = 0)
SELECT hops, path FROM walk WHERE node = {B} ORDER BY hops, path LIMIT 1"""
)
def undirected_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one nation up to their region and down to another."""
    ends = spark.range(1).select(*[node_id(F.lit("Jurisdiction"), F.lit(k)) for k in ("N0", "N5")]).first()
    return graph.shortest_path(builders.edges(spark, sf_dir, _structure()), ends[0], ends[1], builders.nodes(spark, sf_dir), 3, directed=False)


NOTES = """notes AS (SELECT vec_id AS note_id, vec_id % 7 AS user_id, e, (vec_id % 10) / 10.0::DOUBLE AS importance, TIMESTAMP '2024-01-01' AS made, TIMESTAMP '2024-01-11' AS ends FROM v WHERE label < 5
  UNION ALL SELECT vec_id, vec_id % 7, e, (vec_id % 10) / 10.0::DOUBLE, TIMESTAMP '2024-01-05', NULL FROM v WHERE label >= 5)"""


@query(
    f"""WITH {V}, {NOTES}, used AS (SELECT n.note_id FROM notes n, v q WHERE q.vec_id = 0 AND (ends IS NULL OR ends > TIMESTAMP '2024-01-20') ORDER BY round(1 - list_cosine_similarity(n.e, q.e) - 0.1::DOUBLE * importance, 6), note_id LIMIT 8)
SELECT note_id, user_id, CAST(made AS DATE) AS created_on, CAST(ends AS DATE) AS expires_on, CAST(CASE WHEN note_id IN (SELECT note_id FROM used) THEN TIMESTAMP '2024-01-20' ELSE made END AS DATE) AS used_on FROM notes"""
)
def memory_remember(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of notes, written and appended; a recall later on marks what it used."""
    v = _vectors(spark, sf_dir)
    notes = v.select(F.col("vec_id").alias("note_id"), (F.col("vec_id") % 7).alias("user_id"), F.lit("user").alias("scope"), F.concat(F.lit("note "), "vec_id").alias("content"), ((F.col("vec_id") % 10) / 10.0).alias("importance"), "embedding", "label")
    path = sinks.new_path(spark, "memory")
    sinks.overwrite(serving.remembered(notes.where("label < 5"), "2024-01-01", 10), path)
    sinks.append(serving.remembered(notes.where("label >= 5"), "2024-01-05"), path)
    memory = spark.read.parquet(path)
    first = v.where("vec_id = 0").select(F.col("embedding").alias("q")).limit(1)
    used = retrieval.recall(memory.crossJoin(F.broadcast(first)), F.col("q"), 8, "2024-01-20", "note_id")
    day = lambda c, name: F.col(c).cast("date").alias(name)
    return serving.touched(memory, used, "2024-01-20").select("note_id", "user_id", day("created_at", "created_on"), day("expires_at", "expires_on"), day("last_used", "used_on"))


@query(f"WITH {BM25} SELECT query_id, 'text' AS mode, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY rank) AS hit_ids, CAST(count(*) AS INTEGER) AS n_hits FROM lex GROUP BY query_id")
def retrieval_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.new_path(spark, "retrievals")
    sinks.append(serving.audit(_lexical(spark, sf_dir).withColumnRenamed("doc_id", "id"), "text", "2024-01-20"), path)
    return spark.read.parquet(path).select("query_id", "mode", F.array_join(F.transform("hit_ids", lambda h: h.cast("string")), ",").alias("hit_ids"), "n_hits")


@query(f"WITH t AS (SELECT doc_id, unnest({TERMS}) AS term FROM documents) SELECT term, count(DISTINCT doc_id) AS n_docs, count(*) AS n_times FROM t GROUP BY term")
def text_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored inverted index by buckets of terms, and what it says of each term."""
    path = sinks.new_path(spark, "index")
    postings = retrieval.counted(table(spark, sf_dir, "documents"))  # written where they are counted
    sinks.replace_partitions(postings.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(64))), path, "bucket")
    return spark.read.parquet(path).groupBy("term").agg(F.count("*").alias("n_docs"), F.sum("tf").alias("n_times"))


@query(f"WITH {BM25}, near AS ({KNN.format(where='')}), both_ AS (SELECT query_id, doc_id, score FROM lex UNION ALL SELECT query_id, vec_id, 10.0::DOUBLE * score FROM near), s AS (SELECT query_id, doc_id, round(sum(score), 6) AS score FROM both_ GROUP BY 1, 2) SELECT query_id, doc_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 20")
def one_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and vectors in one score; the vector with a document's number is the document's."""
    v = _vectors(spark, sf_dir)
    asked = v.where(F.col("vec_id") % ASKED == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return retrieval.one_score(_lexical(spark, sf_dir), retrieval.knn(v, asked, 10).withColumnRenamed("vec_id", "doc_id"))


@query(FEEDS + ", runs AS (SELECT a, b, method, score, 1 AS run FROM exact WHERE a <> b UNION ALL SELECT a, b, method, score, 2 FROM rule WHERE a <> b) SELECT a, b, arg_max(method, score) AS method, max(score) AS score, CAST(min(run) AS INTEGER) AS run FROM runs GROUP BY a, b")
def same_as_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of one run, kept when the next one finds them again or others."""
    rows, path = _feeds(spark, sf_dir), sinks.new_path(spark, "same-as")
    sinks.overwrite(resolve.match_exact(rows).withColumn("run", F.lit(1)), path)
    return resolve.keep_links(spark.read.parquet(path), resolve.match_names(rows).withColumn("run", F.lit(2)))


@query("SELECT event_type, count(*) AS n, CAST(0 AS BIGINT) AS n_props, sum(value) IS NOT NULL AS has_value FROM events GROUP BY event_type")
def payload_reclaim(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = sinks.reclaimed(table(spark, sf_dir, "events"), sinks.new_path(spark, "events"), "props")
    return left.groupBy("event_type").agg(F.count("*").alias("n"), F.count("props").alias("n_props"), F.sum("value").isNotNull().alias("has_value"))


HASHED = ("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("SELECT c_custkey, sha256(" + " || ',' || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in HASHED) + ") AS content_hash FROM customer")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", content_hash(*[F.col(c) for c in HASHED]).alias("content_hash"))


@query("SELECT doc_id, array_to_string(regexp_extract_all(text, '[A-Z][a-z]+(?: [A-Z][a-z]+)*'), '|') AS names FROM documents")
def capitalised_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(capitalised(F.col("text")), "|").alias("names"))


SAID = "Name the entities and relations of the text as JSON."
SCHEMA = json.dumps([{"edge": e, "from": s, "to": d} for e, s, d, _, llm in RULES if llm])


@query(f"SELECT CAST(item_id AS VARCHAR) AS chunk_id, 'system' AS first_role, '{SAID}' || chr(10) || '{SCHEMA}' AS instruction, 'user' AS last_role, coalesce(text, '') AS said FROM benchmark")
def build_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extraction.messages(table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("chunk_id"), "text"), SAID)
    first, last = F.col("messages")[0], F.col("messages")[1]
    return rows.select("chunk_id", first["role"].alias("first_role"), first["content"].alias("instruction"), last["role"].alias("last_role"), last["content"].alias("said"))


@query(
    f"""WITH good AS (SELECT event_id, event_type, user_id, CAST(event_id % 3 AS INTEGER) AS tier FROM events WHERE event_id % 11 <> 0),
m AS (SELECT user_id, tier, {sql_node_id('Jurisdiction', "'H'")} AS dst FROM good UNION ALL SELECT user_id, tier, {sql_node_id('Counterparty', "'U' || user_id")} FROM good WHERE event_type <> 'error')
SELECT {sql_node_id('Document', "CAST(user_id AS VARCHAR)")} AS src, 'MENTIONS' AS edge_type, dst, max(tier) AS masking_tier, count(*) AS n_chunks, 0.75::DOUBLE AS confidence FROM m GROUP BY user_id, dst"""
)
def document_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events are a document, each event one of its chunks."""
    chunks = table(spark, sf_dir, "events").select(F.concat(F.lit("c_"), "event_id").alias("chunk_id"), F.col("user_id").alias("doc_id"), (F.col("event_id") % 3).cast("int").alias("masking_tier"))
    return extraction.documented(extraction.parse(_payloads(spark, sf_dir))[0], chunks)[1]


def _writer() -> Callable[[list[str], list[str]], str]:
    """Stands for a language model; of communities without relations it gives bare text."""
    return lambda names, relations: json.dumps({"title": names[0], "summary": f"{len(names)} members, {len(relations)} relations", "rating": len(names) / 10}) if relations else f"alone: {names[0]}"


@query(
    GRAPH + """, members AS (SELECT e.dst AS community_id, n.node_id, n.name, row_number() OVER (PARTITION BY e.dst ORDER BY n.node_id) AS rn FROM edges e JOIN nodes n ON n.node_id = e.src WHERE edge_type IN ('LOCATED_IN', 'ROLLS_UP_TO')),
m AS (SELECT community_id, min(name) FILTER (WHERE rn = 1) AS head, least(count(*), 80) AS n FROM members GROUP BY community_id), r AS (SELECT src AS community_id, count(*) AS k FROM edges WHERE edge_type = 'ROLLS_UP_TO' GROUP BY src)
SELECT community_id, CASE WHEN k IS NOT NULL THEN head END AS title, CASE WHEN k IS NULL THEN 'alone: ' || head ELSE n || ' members, ' || k || ' relations' END AS summary, CASE WHEN k IS NULL THEN 0.0 ELSE n / 10.0 END::DOUBLE AS rating FROM m LEFT JOIN r USING (community_id)"""
)
def community_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places are communities of what lies in them; nations have a relation to tell of, regions none."""
    edges = builders.edges(spark, sf_dir, _structure())
    members = edges.select(F.col("dst").alias("community_id"), F.col("src").alias("node_id")).join(builders.nodes(spark, sf_dir).select("node_id", "name"), "node_id")
    relations = edges.where("edge_type = 'ROLLS_UP_TO'").select(F.col("src").alias("community_id"), "src", "edge_type", "dst")
    return serving.summaries(members, relations, _writer)


@query(NODES + "SELECT node_id, node_type, name, masking_tier FROM nodes WHERE canonical_key IN ('N0', 'S1', 'P1') AND masking_tier <= 1")
def get_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes by their keys, as far as the caller may see them."""
    return builders.nodes(spark, sf_dir).where(F.col("canonical_key").isin("N0", "S1", "P1") & (F.col("masking_tier") <= 1)).select("node_id", "node_type", "name", "masking_tier")
