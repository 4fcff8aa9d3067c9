"""Queries: texts, vectors, memory, extraction, fused retrieval."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import node_id
from ..functions.vectors import cosine
from ..operators import extraction, graph, retrieval
from ..operators.nearest import VectorIndex
from ..sources import builders, sinks
from ..sources.shared import stored
from .registry import NODES, query, sql_node_id, table
from .walks import CLOSED, DAY, _hot_from

#: Which rows ask: those whose id is divisible by this.
ASKED = 20
TERMS = "regexp_extract_all(lower(text), '[\\p{L}0-9]+')"
#: BM25 of the benchmark items that ask over all documents.
BM25 = f"""docs AS MATERIALIZED (SELECT doc_id, {TERMS} AS ts FROM documents), stat AS (SELECT count(*) AS n, sum(len(ts))::DOUBLE / count(*) AS mean FROM docs),
q AS (SELECT DISTINCT item_id AS query_id, unnest({TERMS}) AS term FROM benchmark WHERE item_id % {ASKED} = 0),
tf AS (SELECT doc_id, len(ts) AS length, unnest(ts) AS term FROM docs), hits AS (SELECT doc_id, length, term, count(*) AS tf FROM tf WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM hits GROUP BY term),
raw AS (SELECT query_id, doc_id, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))) AS score FROM hits JOIN df USING (term) JOIN q USING (term), stat GROUP BY 1, 2),
lex AS (SELECT * FROM (SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM raw) WHERE rank <= 20)"""
OVERLAP = f"""cut AS (SELECT doc_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: length(x) >= 3))) AS term FROM documents),
qcut AS (SELECT item_id AS query_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: length(x) >= 3))) AS term FROM benchmark WHERE item_id % {ASKED} = 0),
over AS (SELECT * FROM (SELECT query_id, doc_id, count(*) AS score, row_number() OVER (PARTITION BY query_id ORDER BY count(*) DESC, doc_id) AS rank FROM cut JOIN qcut USING (term) GROUP BY 1, 2) WHERE rank <= 20)"""


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").where(F.col("item_id") % ASKED == 0).select(F.col("item_id").alias("query_id"), "text")


def _lexical(spark: SparkSession, sf_dir: str, asked: DataFrame | None = None) -> DataFrame:
    asked = _asked(spark, sf_dir) if asked is None else asked
    index, n, mean = retrieval.asked_postings(table(spark, sf_dir, "documents"), asked)
    hits = retrieval.bm25(index, asked, n, mean)
    return retrieval.top(hits.withColumn("score", F.round("score", 6)), "score", 20)


def _first_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, score of the texts that the first question finds; read more than once."""
    return stored(_lexical(spark, sf_dir, _asked(spark, sf_dir).where("query_id = 0")).select("doc_id", "score"), "text-hits")


@query(f"WITH {BM25} SELECT query_id, doc_id, score, rank FROM lex")
def bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lexical(spark, sf_dir)


@query(f"WITH {OVERLAP} SELECT query_id, doc_id, score, rank FROM over")
def term_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.top(retrieval.term_overlap(table(spark, sf_dir, "documents"), _asked(spark, sf_dir)), "score", 20)


@query(f"WITH {BM25}, {OVERLAP} SELECT query_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM (SELECT query_id, doc_id, rank FROM lex UNION ALL SELECT query_id, doc_id, rank FROM over) GROUP BY 1, 2")
def rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    over = retrieval.top(retrieval.term_overlap(table(spark, sf_dir, "documents"), _asked(spark, sf_dir)), "score", 20)
    return retrieval.rrf([_lexical(spark, sf_dir), over]).withColumn("score", F.round("score", 9))


V = "v AS (SELECT vec_id, label, CAST(vec_id % 4 AS INTEGER) AS tier, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)"
KNN = f"WITH {V} SELECT query_id, vec_id, score, rank FROM (SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(q.e, v.e), 6) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.e, v.e), 6) DESC, v.vec_id) AS rank FROM v q, v WHERE q.vec_id % 20 = 0{{where}}) WHERE rank <= 10"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumn("tier", (F.col("vec_id") % 4).cast("int"))


def _nearest(vectors: DataFrame, all_vectors: DataFrame) -> DataFrame:
    queries = all_vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return retrieval.knn(vectors, queries, 10)


@query(KNN.format(where=""))
def knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(_vectors(spark, sf_dir), _vectors(spark, sf_dir))


@query(KNN.format(where=" AND v.tier <= 1 AND v.label IN (1, 2, 3)"))
def knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nearest(_vectors(spark, sf_dir).where("tier <= 1 AND label IN (1, 2, 3)"), _vectors(spark, sf_dir))


@query(KNN.format(where=" AND v.tier <= 1 AND v.label IN (1, 2, 3)"))
def knn_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As knn_filtered, out of a stored index: blocks of other tiers and labels are not opened, cells that are too far away not looked into."""
    v = _vectors(spark, sf_dir)
    index = VectorIndex.build(v, sinks.new_path(spark, "vectors"), 32, ("tier", "label"))
    queries = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return index.search(queries, 10, (F.col("tier") <= 1) & F.col("label").isin(1, 2, 3)).drop("cells")


@query(
    f"""WITH {V}, m AS (SELECT *, (vec_id % 10) / 10.0::DOUBLE AS importance, CASE vec_id % 3 WHEN 0 THEN 'global' WHEN 1 THEN 'user' ELSE 'team' END AS scope, vec_id % 7 AS user_id FROM v)
SELECT m.vec_id, round(1 - list_cosine_similarity(m.e, q.e) - 0.1::DOUBLE * importance, 6) AS distance FROM m, v q WHERE q.vec_id = 0 AND (scope = 'global' OR (scope = 'user' AND user_id = 3)) ORDER BY distance, m.vec_id LIMIT 8"""
)
def memory_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = _vectors(spark, sf_dir)
    scope = F.when(F.col("vec_id") % 3 == 0, "global").when(F.col("vec_id") % 3 == 1, "user").otherwise("team")
    m = v.withColumns({"importance": (F.col("vec_id") % 10) / 10.0, "scope": scope, "user_id": F.col("vec_id") % 7, "expires_at": F.lit(None).cast("timestamp")})
    first = v.where("vec_id = 0").select(F.col("embedding").alias("q"))  # one row
    mine = m.where((F.col("scope") == "global") | ((F.col("scope") == "user") & (F.col("user_id") == 3))).crossJoin(F.broadcast(first))
    return retrieval.recall(mine, F.col("q")).select("vec_id", F.col("order").alias("distance"))


@query(
    """WITH l AS (SELECT user_id AS key, arg_max(value, event_id) AS value, max(event_id) AS event_id, max_by(ts, event_id) AS ts FROM events GROUP BY user_id)
SELECT key, value FROM l WHERE ts + to_days(CAST(event_id % 5 AS INTEGER)) > TIMESTAMP '2024-01-31'"""
)
def cache_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("key")).agg(F.max_by(F.struct("value", "event_id", "ts"), "event_id").alias("e")).select("key", "e.*")
    expires = F.timestamp_add("DAY", (F.col("event_id") % 5).cast("int"), F.col("ts"))
    return last.where(expires > F.to_timestamp(F.lit("2024-01-31"))).select("key", "value")


GRAMS = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(generate_series(1, length(w) + 1), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query(
    NODES + f""", q AS (SELECT n_nationkey AS query_id, {GRAMS.format(c="'supplier ' || lpad(CAST(n_nationkey AS VARCHAR), 9, '0')")} AS g FROM nation),
n AS (SELECT node_id, {GRAMS.format(c="name")} AS g FROM nodes WHERE node_type = 'LegalEntity'),
s AS (SELECT query_id, node_id, round(len(list_intersect(q.g, n.g))::DOUBLE / len(list_distinct(list_concat(q.g, n.g))), 6) AS score FROM q, n)
SELECT query_id, node_id, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, node_id) AS rank FROM s WHERE score >= 0.3) WHERE rank <= 5"""
)
def trigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("query_id"), F.concat(F.lit("supplier "), F.lpad(F.col("n_nationkey").cast("string"), 9, "0")).alias("text"))
    return retrieval.link_names(names, builders.nodes(spark, sf_dir).where("node_type = 'LegalEntity'"))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extractor's answers about events: some fenced, some broken, some with unknown types, forbidden or dangling relations."""
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "error", "Alien").otherwise("Counterparty")
    body = F.to_json(F.struct(
        F.array(F.struct(kind.alias("type"), F.concat(F.lit("user "), "user_id").alias("name"), F.concat(F.lit("U"), "user_id").alias("key")), F.struct(F.lit("Jurisdiction").alias("type"), F.lit("Home").alias("name"), F.lit("H").alias("key"))).alias("entities"),
        F.array(F.struct(F.when(F.col("event_type") == "click", "EXPOSED_TO").otherwise("LOCATED_IN").alias("type"), F.concat(F.lit("U"), "user_id").alias("from_key"), F.when(F.col("event_type") == "view", "Z").otherwise("H").alias("to_key"), F.lit("q").alias("quote"), F.lit(0.0).alias("weight"))).alias("relations"),
    ))
    raw = F.when(F.col("event_id") % 11 == 0, "not json").when(F.col("event_id") % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    return e.select(F.concat(F.lit("c_"), "event_id").alias("chunk_id"), raw.alias("raw_json"))


@query(
    """SELECT 'c_' || event_id AS chunk_id, (CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_type = 'error' THEN 1 ELSE 2 END)::BIGINT AS n_nodes,
  (CASE WHEN event_id % 11 <> 0 AND event_type NOT IN ('error', 'click', 'view') THEN 1 ELSE 0 END)::BIGINT AS n_edges,
  (CASE WHEN event_id % 11 = 0 THEN 1 WHEN event_type = 'error' THEN 2 WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END)::BIGINT AS n_rejected FROM events"""
)
def extract_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.parse(_payloads(spark, sf_dir))[2]


@query("SELECT 100.0::DOUBLE * sum(r) / greatest(sum(n + e + r), 1) AS reject_rate FROM (SELECT CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_type = 'error' THEN 1 ELSE 2 END AS n, CASE WHEN event_id % 11 <> 0 AND event_type NOT IN ('error', 'click', 'view') THEN 1 ELSE 0 END AS e, CASE WHEN event_id % 11 = 0 THEN 1 WHEN event_type = 'error' THEN 2 WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS r FROM events)")
def reject_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = extraction.parse(_payloads(spark, sf_dir))[2]
    return audit.agg((100.0 * F.sum("n_rejected") / F.greatest(F.sum(F.col("n_nodes") + F.col("n_edges") + F.col("n_rejected")), F.lit(1))).alias("reject_rate"))


@query()
def chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.chunk(table(spark, sf_dir, "documents"))


def _stub() -> Callable[[str], str]:
    """Stands for a language model: the capitalised words of a text are its jurisdictions."""
    import json
    import re

    return lambda text: json.dumps({"entities": [{"type": "Jurisdiction", "name": w, "key": w} for w in dict.fromkeys(re.findall(r"\b[A-Z][a-z]+\b", text))], "relations": []})


@query()
def extract_llm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.parse(extraction.extract(extraction.chunk(table(spark, sf_dir, "documents")), _stub))[2]


#: Which nodes a document mentions: a nation and a supplier, by its number.
MENTIONS = f"""mentions AS (SELECT doc_id, {sql_node_id('Jurisdiction', "'N' || (doc_id % 25)")} AS node_id FROM documents
  UNION ALL SELECT doc_id, {sql_node_id('LegalEntity', "'S' || (doc_id % 10)")} FROM documents)"""


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id")
    one = d.select("doc_id", node_id(F.lit("Jurisdiction"), F.concat(F.lit("N"), F.col("doc_id") % 25)).alias("node_id"))
    return one.unionByName(d.select("doc_id", node_id(F.lit("LegalEntity"), F.concat(F.lit("S"), F.col("doc_id") % 10)).alias("node_id")))


@query(NODES + f", {MENTIONS} SELECT doc_id, string_agg(DISTINCT name, '|' ORDER BY name) AS names, string_agg(DISTINCT node_id, '|' ORDER BY node_id) AS ids FROM documents LEFT JOIN mentions USING (doc_id) LEFT JOIN nodes USING (node_id) GROUP BY doc_id")
def enrich_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _mentions(spark, sf_dir).join(builders.nodes(spark, sf_dir).select("node_id", "name"), "node_id", "left")
    named = table(spark, sf_dir, "documents").select("doc_id").join(named, "doc_id", "left")  # those without mentions stay
    said = lambda c: F.nullif(F.array_join(F.array_sort(F.collect_set(c)), "|"), F.lit("")).alias(f"{c}_list")
    return named.groupBy("doc_id").agg(said("name"), said("node_id")).select("doc_id", F.col("name_list").alias("names"), F.col("node_id_list").alias("ids"))


#: Local mode for the first question: text hits, seeds by their mentions, the closure around the seeds, one ranking.
LOCAL = f""", {BM25}, {MENTIONS}, hit AS (SELECT doc_id, score FROM lex WHERE query_id = 0),
seed AS (SELECT * FROM (SELECT node_id, round(sum(score), 6) AS seed FROM hit JOIN mentions USING (doc_id) GROUP BY node_id) ORDER BY seed DESC, node_id LIMIT 10),
near AS (SELECT c.* FROM closed c JOIN seed ON c.src = node_id WHERE hops <= 2 ORDER BY hops, weight DESC, src, dst LIMIT 200)"""
RANKED = """, ranked AS (
  SELECT 'chunk' AS kind, CAST(doc_id AS VARCHAR) AS id, round(score + 0.05::DOUBLE * coalesce((SELECT sum(seed) FROM mentions m JOIN seed s USING (node_id) WHERE m.doc_id = hit.doc_id), 0), 6) AS score FROM hit
  UNION ALL SELECT 'edge', src || '>' || dst, round(0.4::DOUBLE + 0.1::DOUBLE * (coalesce(a.seed, 0) + coalesce(b.seed, 0)), 6) FROM near LEFT JOIN seed a ON a.node_id = src LEFT JOIN seed b ON b.node_id = dst
  UNION ALL SELECT 'node', id, round(0.3::DOUBLE + 0.1::DOUBLE * coalesce(seed, 0), 6) FROM (SELECT src AS id FROM near UNION SELECT dst FROM near) LEFT JOIN seed ON node_id = id)"""


def _local(spark: SparkSession, sf_dir: str, hit: DataFrame | None = None, k: int = 60, day: str = DAY) -> DataFrame:
    """hit (doc_id, score): what the first question finds, or as much of it as counts."""
    hit = _first_hits(spark, sf_dir) if hit is None else hit
    mentions = _mentions(spark, sf_dir).join(hit.select("doc_id"), "doc_id", "left_semi")
    seed = retrieval.top(hit.join(mentions, "doc_id").groupBy("node_id").agg(F.round(F.sum("score"), 6).alias("seed")), "seed", 10, None, "node_id")
    seed = stored(seed, "seeds")
    near = graph.closure(_hot_from(spark, sf_dir, seed, 2, day=day)[0], 2, seed).orderBy("hops", F.desc("weight"), "src", "dst").limit(200)
    chunks = hit.join(mentions.groupBy("doc_id").agg(F.collect_set("node_id").alias("node_ids")), "doc_id", "left").select(F.col("doc_id").cast("string").alias("id"), "score", "node_ids")
    edges = near.select(F.concat_ws(">", "src", "dst").alias("id"), "src", "dst")
    nodes = near.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return retrieval.rank_hits(chunks, edges, nodes, seed, k)


@query(CLOSED + LOCAL + RANKED + " SELECT kind, id, score FROM ranked ORDER BY score DESC, kind, id LIMIT 60")
def retrieve_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _local(spark, sf_dir)


@query(CLOSED.replace(DAY, "1995-06-01") + LOCAL + RANKED + " SELECT kind, id, score FROM ranked ORDER BY score DESC, kind, id LIMIT 60")
def retrieve_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local mode as of another day."""
    return _local(spark, sf_dir, day="1995-06-01")


#: Communities are the documents' sources; each has a vector (the mean of the label with its number), a rating and the texts of its documents.
GLOBAL = f"""{V}, centre AS (SELECT label, i, avg(e[i]) AS x FROM v, generate_series(1, 64) t(i) GROUP BY ALL), mean AS (SELECT label, list(x ORDER BY i) AS c FROM centre GROUP BY label),
com AS (SELECT DISTINCT source, CAST(substr(source, 4) AS INTEGER) AS no FROM documents),
cos AS (SELECT source, no % 5 AS rating, list_cosine_similarity(c, q.e) AS s FROM com JOIN mean ON label = no % 10, v q WHERE q.vec_id = 0),
vec AS (SELECT source, rating, round(s, 6) AS s FROM cos ORDER BY round(s, 6) DESC, source LIMIT 8),
{BM25}, txt AS (SELECT source, round(sum(score), 6) AS t FROM lex JOIN documents USING (doc_id) WHERE query_id = 0 GROUP BY source ORDER BY t DESC, source LIMIT 8),
best AS (SELECT coalesce(vec.source, txt.source) AS source, round(coalesce(s, 0) + CASE WHEN txt.source IS NULL THEN 0 ELSE 0.5::DOUBLE END, 6) AS score FROM vec FULL JOIN txt ON vec.source = txt.source),
top6 AS (SELECT best.source, score FROM best JOIN com USING (source) ORDER BY round(score + 0.05::DOUBLE * (no % 5), 6) DESC, source LIMIT 6)"""


def _global(spark: SparkSession, sf_dir: str, hit: DataFrame | None = None) -> DataFrame:
    hit = _first_hits(spark, sf_dir) if hit is None else hit
    v = _vectors(spark, sf_dir)
    mean = v.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    mean = mean.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("c"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    com = docs.select("source", F.substring("source", 4, 9).cast("int").alias("no")).distinct()
    q = v.where("vec_id = 0").select(F.col("embedding").alias("q"))  # one row
    cos = com.join(mean, F.col("label") == F.col("no") % 10).crossJoin(F.broadcast(q)).select("source", F.round(cosine(F.col("c"), F.col("q")), 6).alias("s"))
    vec = retrieval.top(cos, "s", 8, None, "source")
    txt = hit.join(docs, "doc_id").groupBy("source").agg(F.round(F.sum("score"), 6).alias("t"))
    txt = retrieval.top(txt, "t", 8, None, "source")
    score = F.round(F.coalesce("s", F.lit(0.0)) + F.when(F.col("t").isNull(), 0.0).otherwise(0.5), 6)
    best = vec.join(txt, "source", "full").select("source", score.alias("score")).join(com, "source")
    return retrieval.top(best.withColumn("by", F.round(F.col("score") + 0.05 * (F.col("no") % 5), 6)), "by", 6, None, "source").select("source", "score")


@query(f"WITH {GLOBAL} SELECT source, score FROM top6")
def retrieve_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _global(spark, sf_dir)


@query(
    CLOSED + f""", {GLOBAL}, {MENTIONS}, chosen AS (SELECT source, score FROM top6 ORDER BY score DESC, source LIMIT 3),
hit AS (SELECT doc_id, lex.score FROM lex JOIN documents USING (doc_id) WHERE query_id = 0 AND source IN (SELECT source FROM chosen)),
seed AS (SELECT * FROM (SELECT node_id, round(sum(score), 6) AS seed FROM hit JOIN mentions USING (doc_id) GROUP BY node_id) ORDER BY seed DESC, node_id LIMIT 10),
near AS (SELECT c.* FROM closed c JOIN seed ON c.src = node_id WHERE hops <= 2 ORDER BY hops, weight DESC, src, dst LIMIT 200)""" + RANKED + """,
own AS (SELECT * FROM ranked ORDER BY score DESC, kind, id LIMIT 60) SELECT 'community' AS kind, source AS id, score FROM chosen UNION ALL SELECT kind, id, score FROM own"""
)
def retrieve_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = _first_hits(spark, sf_dir)  # one search for both modes
    chosen = stored(retrieval.top(_global(spark, sf_dir, hit), "score", 3, None, "source"), "chosen")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source").join(hit.select("doc_id"), "doc_id", "left_semi")
    own = stored(hit.join(docs.join(chosen, "source", "left_semi"), "doc_id", "left_semi"), "text-hits")
    return chosen.select(F.lit("community").alias("kind"), F.col("source").alias("id"), "score").unionByName(_local(spark, sf_dir, own))


@query(
    CLOSED.split(", p1 AS")[0] + f""", names AS (SELECT node_id FROM nodes WHERE canonical_key IN ('S1', 'S2') AND node_type = 'LegalEntity'), walk AS (SELECT node_id AS seed, node_id AS node, 0 AS hops, name AS text, node_id AS path FROM names JOIN nodes USING (node_id)
  UNION ALL SELECT seed, dst, hops + 1, text || ' [' || edge_type || '] -> ' || name, path || '>' || dst FROM walk JOIN hot ON src = node JOIN nodes ON nodes.node_id = dst WHERE hops < 6 AND edge_type IN ('LOCATED_IN', 'ROLLS_UP_TO') AND strpos(path, dst) = 0)
SELECT seed, path, text, round(1.0::DOUBLE / (1 + hops), 6) AS score FROM walk WHERE hops > 0 ORDER BY hops, path LIMIT 40"""
)
def retrieve_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = builders.nodes(spark, sf_dir)
    seeds = nodes.where(F.col("canonical_key").isin("S1", "S2") & (F.col("node_type") == "LegalEntity")).select("node_id")
    edges = _hot_from(spark, sf_dir, seeds, 6)[0].where("edge_type IN ('LOCATED_IN', 'ROLLS_UP_TO')")
    walks = graph.traverse(edges, seeds, nodes, 6, 3, None, 40)  # all of weight one, so by hops and path
    steps = walks.select("seed", "hops", F.array_join("path", ">").alias("path"), F.posexplode("path").alias("at", "node_id")).join(nodes.select("node_id", "name"), "node_id")
    before = F.lag("node_id").over(W.partitionBy("path").orderBy("at"))
    kinds = edges.groupBy(F.col("src").alias("before"), F.col("dst").alias("node_id")).agg(F.min("edge_type").alias("edge_type"))
    steps = steps.withColumn("before", before).join(kinds, ["before", "node_id"], "left")
    said = F.when(F.col("edge_type").isNull(), F.col("name")).otherwise(F.concat(F.lit(" ["), "edge_type", F.lit("] -> "), "name"))
    return steps.groupBy("seed", "path", "hops").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", said.alias("x")))), lambda s: s["x"]), "").alias("text")).select("seed", "path", "text", F.round(1.0 / (1 + F.col("hops")), 6).alias("score"))


@query(CLOSED + f" SELECT hops, path FROM closed WHERE src = {sql_node_id('LegalEntity', "'S2'")} AND dst = {sql_node_id('Jurisdiction', "'R3'")} ")
def retrieve_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = spark.range(1).select(node_id(F.lit("LegalEntity"), F.lit("S2")), node_id(F.lit("Jurisdiction"), F.lit("R3"))).first()
    start = spark.range(1).select(F.lit(ends[0]).alias("node_id"))
    edges, nodes = _hot_from(spark, sf_dir, start, 3)
    closed = graph.closure(edges.join(nodes.where("masking_tier <= 3").select(F.col("node_id").alias("dst")), "dst", "left_semi"), 3, start)
    return closed.where((F.col("src") == ends[0]) & (F.col("dst") == ends[1])).select("hops", F.array_join("path", ">").alias("path"))


@query(
    """WITH c AS (SELECT CAST(doc_id AS VARCHAR) AS id, (doc_id % 100) / 100.0::DOUBLE AS score, doc_id % 25 AS n FROM documents), s AS (SELECT n_nationkey AS n, n_nationkey / 10.0::DOUBLE AS seed FROM nation WHERE n_nationkey % 3 = 0),
r AS (SELECT 'chunk' AS kind, id, round(score + 0.05::DOUBLE * coalesce(seed, 0), 6) AS score FROM c LEFT JOIN s USING (n)
  UNION ALL SELECT 'edge', n_nationkey || '>' || (n_nationkey + 1), round(0.4::DOUBLE + 0.1::DOUBLE * (coalesce(a.seed, 0) + coalesce(b.seed, 0)), 6) FROM nation LEFT JOIN s a ON a.n = n_nationkey LEFT JOIN s b ON b.n = n_nationkey + 1
  UNION ALL SELECT 'node', CAST(n_nationkey AS VARCHAR), round(0.3::DOUBLE + 0.1::DOUBLE * coalesce(seed, 0), 6) FROM nation LEFT JOIN s ON s.n = n_nationkey)
SELECT kind, id, score FROM r ORDER BY score DESC, kind, id LIMIT 60"""
)
def rank_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    seeds = n.where("n_nationkey % 3 = 0").select(F.col("n_nationkey").cast("string").alias("node_id"), (F.col("n_nationkey") / 10.0).alias("seed"))
    chunks = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), ((F.col("doc_id") % 100) / 100.0).alias("score"), F.array((F.col("doc_id") % 25).cast("string")).alias("node_ids"))
    edges = n.select(F.concat_ws(">", "n_nationkey", F.col("n_nationkey") + 1).alias("id"), F.col("n_nationkey").cast("string").alias("src"), (F.col("n_nationkey") + 1).cast("string").alias("dst"))
    return retrieval.rank_hits(chunks, edges, n.select(F.col("n_nationkey").cast("string").alias("id")), seeds)
