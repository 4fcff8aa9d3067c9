"""Queries: building nodes and edges, validation, versions and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import hashed_id, node_id, render
from ..operators import ontology, temporal
from ..sources import builders
from .registry import GRAPH, NODES, VERSIONS, query, table

RULES_SQL = ", rules(edge_type, src_type, dst_type) AS (VALUES " + ", ".join(f"('{e}', '{s}', '{d}')" for e, ss, ds, _, _ in ontology.RULES for s in ss for d in ds) + ")"
#: All edges, and each FUNDS edge once more the wrong way round, and one edge into nowhere for each nation.
PROPOSED_SQL = """, proposed AS (
  SELECT src, dst, edge_type FROM edges UNION ALL SELECT dst, src, 'FUNDS' FROM edges WHERE edge_type = 'FUNDS'
  UNION ALL SELECT src, 'n_nowhere', 'LOCATED_IN' FROM edges WHERE edge_type = 'ROLLS_UP_TO'),
typed AS (SELECT p.*, a.node_type AS src_type, b.node_type AS dst_type FROM proposed p LEFT JOIN nodes a ON a.node_id = p.src LEFT JOIN nodes b ON b.node_id = p.dst)"""


NOWHERE = "n_nowhere"


def _proposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """src, dst, edge_type with plain ends, all in one pass over the edges."""
    edge = lambda a, b, kind: F.struct(a.alias("src"), b.alias("dst"), kind.alias("edge_type"))
    src, dst, kind = F.col("src"), F.col("dst"), F.col("edge_type")
    more = F.when(kind == "FUNDS", F.array(edge(src, dst, kind), edge(dst, src, kind))).when(kind == "ROLLS_UP_TO", F.array(edge(src, dst, kind), edge(src, F.lit(NOWHERE), F.lit("LOCATED_IN"))))
    return builders.edges(spark, sf_dir, plain=True).select(F.inline(F.coalesce(more, F.array(edge(src, dst, kind)))))


def _hashed_ends(rows: DataFrame) -> DataFrame:
    """Plain ends as ids of nodes; what is no plain end stays."""
    return rows.withColumns({c: F.when(F.col(c).contains("|"), hashed_id(F.col(c))).otherwise(F.col(c)) for c in ("src", "dst")})


@query(NODES + "SELECT node_id, node_type, name, canonical_key, properties, masking_tier, source_system, confidence FROM nodes")
def build_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builders.nodes(spark, sf_dir).withColumn("properties", render(F.col("properties")))


@query(GRAPH + "SELECT edge_id, series_id, src, dst, edge_type, weight, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, confidence FROM edges")
def build_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builders.edges(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


@query(NODES + "SELECT node_type, count(*) AS n, count(DISTINCT node_id) AS ids, min(node_id) AS first_id FROM nodes GROUP BY node_type")
def node_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return builders.nodes(spark, sf_dir).groupBy("node_type").agg(F.count("*").alias("n"), F.countDistinct("node_id").alias("ids"), F.min("node_id").alias("first_id"))


@query(
    NODES + """, hosts AS (SELECT DISTINCT regexp_extract(url, '://([^/?#]*)', 1) AS host FROM pages WHERE url LIKE '%://%'),
staged AS (SELECT node_id, node_type, name, source_system FROM nodes UNION ALL
  SELECT 'n_' || substr(sha1('DataAsset|' || upper(host)), 1, 20), 'DataAsset', host, 'lineage' FROM hosts)
SELECT source_system, node_type, count(*) AS n, min(node_id) AS first_id, max(name) AS last_name FROM staged GROUP BY 1, 2"""
)
def union_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = table(spark, sf_dir, "pages").where(F.col("url").contains("://")).select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("name")).distinct()
    assets = hosts.select(F.lit("lineage").alias("source_system"), node_id(F.lit("DataAsset"), F.col("name")).alias("node_id"), "name", F.lit("DataAsset").alias("node_type"))
    staged = builders.nodes(spark, sf_dir).select("node_id", "node_type", "name", "source_system").unionByName(assets)
    return staged.groupBy("source_system", "node_type").agg(F.count("*").alias("n"), F.min("node_id").alias("first_id"), F.max("name").alias("last_name"))


@query(GRAPH + RULES_SQL + PROPOSED_SQL + " SELECT edge_type, src_type, dst_type, count(*) AS n FROM typed SEMI JOIN rules USING (edge_type, src_type, dst_type) GROUP BY ALL")
def ontology_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ontology.validate(_proposed(spark, sf_dir), builders.nodes(spark, sf_dir, plain=True)).groupBy("edge_type", "src_type", "dst_type").agg(F.count("*").alias("n"))


@query(
    GRAPH + RULES_SQL + PROPOSED_SQL + """ SELECT edge_type, src, dst, CASE WHEN src_type IS NULL OR dst_type IS NULL THEN 'missing node'
  WHEN edge_type NOT IN (SELECT edge_type FROM rules) THEN 'unknown edge' ELSE 'forbidden' END AS reason FROM typed ANTI JOIN rules USING (edge_type, src_type, dst_type)"""
)
def ontology_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed_ends(ontology.rejects(_proposed(spark, sf_dir), builders.nodes(spark, sf_dir, plain=True))).select("edge_type", "src", "dst", "reason")


HOLDS = "valid_from <= DATE '{d}' AND (valid_to IS NULL OR valid_to > DATE '{d}')"


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.daily_versions(table(spark, sf_dir, "events"))


@query(VERSIONS + "SELECT key, value, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM versions WHERE " + HOLDS.format(d="2024-01-15"))
def as_of_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = temporal.as_of(_versions(spark, sf_dir), "2024-01-15")
    return rows.select("key", "value", F.col("valid_from").cast("string").alias("valid_from"), F.col("valid_to").cast("string").alias("valid_to"))


@query(
    VERSIONS + """, seen AS (SELECT key, value, valid_from, lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from) AS valid_to FROM versions WHERE recorded_at <= DATE '2024-01-16')
SELECT key, value, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM seen WHERE """ + HOLDS.format(d="2024-01-15")
)
def known_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = temporal.as_of(temporal.known_versions(_versions(spark, sf_dir), "2024-01-16"), "2024-01-15")
    return rows.select("key", "value", F.col("valid_from").cast("string").alias("valid_from"), F.col("valid_to").cast("string").alias("valid_to"))


SNAPSHOTS = """, current AS (SELECT key, arg_max(value, valid_from) AS value, max(valid_from) AS valid_from FROM versions WHERE valid_from < DATE '2024-01-16' GROUP BY key),
staged AS (SELECT key, arg_max(value, valid_from) AS value, max(valid_from) AS valid_from FROM versions WHERE valid_from >= DATE '2024-01-16' OR event_id % 7 = 0 GROUP BY key)"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    versions = _versions(spark, sf_dir)
    latest = lambda rows: rows.groupBy("key").agg(F.max_by("value", "valid_from").alias("value"), F.max("valid_from").alias("valid_from"))
    return latest(versions.where("valid_from < DATE'2024-01-16'")), latest(versions.where("valid_from >= DATE'2024-01-16' OR event_id % 7 = 0"))


@query(
    VERSIONS + SNAPSHOTS + """, b AS (SELECT coalesce(t.key, s.key) AS key, t.value AS tv, t.valid_from AS tf, s.value AS sv, s.valid_from AS sf FROM current t FULL JOIN staged s ON s.key = t.key),
c AS (SELECT *, CASE WHEN tf IS NULL THEN 'new' WHEN sf IS NULL THEN 'kept' WHEN sv = tv THEN 'same' WHEN sf > tf THEN 'changed' ELSE 'late' END AS state FROM b),
r AS (SELECT key, sv AS value, sf AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current, 'inserted' AS action FROM c WHERE state IN ('new', 'changed')
  UNION ALL SELECT key, tv, tf, sf, false, 'closed' FROM c WHERE state = 'changed' UNION ALL SELECT key, sv, sf, tf, false, 'late' FROM c WHERE state = 'late'
  UNION ALL SELECT key, tv, tf, NULL, true, 'kept' FROM c WHERE state IN ('kept', 'same', 'late'))
SELECT key, value, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, is_current, action FROM r"""
)
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = temporal.scd2_merge(*_snapshots(spark, sf_dir))
    return rows.withColumns({c: F.col(c).cast("string") for c in ("valid_from", "valid_to")})


#: Everything that was staged, with contents that are null; the current versions as before.
CHAIN = SNAPSHOTS + """, every AS (SELECT key, CASE WHEN event_id % 11 <> 0 THEN round(value / 100) END AS value, valid_from FROM versions WHERE valid_from >= DATE '2024-01-16' OR event_id % 7 = 0),
held AS (SELECT key, round(value / 100) AS value, valid_from FROM current),
r0 AS (SELECT key, value, valid_from, true AS now FROM held UNION ALL SELECT key, max(value), valid_from, false FROM every GROUP BY key, valid_from),
r1 AS (SELECT *, lag(valid_from) OVER w IS NOT NULL AND lag(value) OVER w IS NOT DISTINCT FROM value AS again FROM r0 WINDOW w AS (PARTITION BY key ORDER BY valid_from, now)),
r2 AS (SELECT *, coalesce(lead(now) OVER w, false) AND lead(value) OVER w IS NOT DISTINCT FROM value AS early FROM r1 WHERE now OR NOT again WINDOW w AS (PARTITION BY key ORDER BY valid_from, now)),
r3 AS (SELECT *, lead(valid_from) OVER w AS valid_to, lead(now) OVER w IS NULL AS is_current, bool_or(now) OVER (PARTITION BY key) AND NOT bool_or(now) OVER (PARTITION BY key ORDER BY valid_from, now ROWS UNBOUNDED PRECEDING) AS late
  FROM r2 WHERE now OR NOT early WINDOW w AS (PARTITION BY key ORDER BY valid_from, now))
SELECT key, value, valid_from, valid_to, is_current, CASE WHEN now AND is_current THEN 'kept' WHEN now THEN 'closed' WHEN late THEN 'late' ELSE 'inserted' END AS action FROM r3"""


@query(VERSIONS + CHAIN)
def scd2_merge_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All staged versions of a key, late ones and null contents among them, are kept and follow each other."""
    hundreds = F.round(F.col("value") / 100)
    staged = _versions(spark, sf_dir).where("valid_from >= DATE'2024-01-16' OR event_id % 7 = 0").select("key", F.when(F.col("event_id") % 11 != 0, hundreds).alias("value"), "valid_from")
    return temporal.scd2_merge(_snapshots(spark, sf_dir)[0].withColumn("value", hundreds), staged)


@query(
    """WITH e AS (SELECT user_id || ':' || event_type AS key, event_id, CASE WHEN event_id % 13 <> 0 THEN round(value / 100) END AS weight, CAST(ts AS DATE) AS day FROM events),
t AS (SELECT key, arg_max(weight, event_id) AS w0, bool_or(weight IS NULL) AS x, min(day) AS valid_from, count(*) AS n FROM e WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' GROUP BY key),
s AS (SELECT key, weight, day AS valid_from, count(*) AS n FROM e WHERE day NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' GROUP BY ALL),
r0 AS (SELECT key, CASE WHEN x THEN NULL ELSE w0 END AS weight, valid_from, n, true AS now FROM t UNION ALL SELECT key, weight, valid_from, n, false FROM s),
r1 AS (SELECT *, lag(n) OVER w IS NULL OR lag(weight) OVER w IS DISTINCT FROM weight AS begins FROM r0 WINDOW w AS (PARTITION BY key ORDER BY valid_from, now, weight NULLS FIRST)),
r2 AS (SELECT *, sum(begins::INT) OVER (PARTITION BY key ORDER BY valid_from, now, weight NULLS FIRST ROWS UNBOUNDED PRECEDING) AS run FROM r1),
r3 AS (SELECT key, run, min(weight) AS weight, sum(n)::BIGINT AS n_evidence, coalesce(min(valid_from) FILTER (now), min(valid_from)) AS valid_from FROM r2 GROUP BY key, run)
SELECT key, weight, n_evidence, valid_from, lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current FROM r3 WINDOW w AS (PARTITION BY key ORDER BY run)"""
)
def edge_supersede_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts from before and after a week against the edges of that week: late ones keep their weight and days, null weights are weights."""
    e = table(spark, sf_dir, "events").select(F.concat_ws(":", "user_id", "event_type").alias("key"), "event_id", F.to_date("ts").alias("day"), F.when(F.col("event_id") % 13 != 0, F.round(F.col("value") / 100)).alias("weight"))
    week = F.col("day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-16").cast("date"))
    chunk = F.concat(F.lit("c_"), "event_id")
    now = e.where(week).groupBy("key").agg(F.max_by("weight", "event_id").alias("w"), F.bool_or(F.col("weight").isNull()).alias("x"), F.min("day").alias("valid_from"), F.collect_set(chunk).alias("evidence"))
    now = now.select("key", F.when(~F.col("x"), F.col("w")).alias("weight"), "evidence", F.lit(0.5).alias("confidence"), "valid_from", F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    staged = e.where(~week).select("key", "weight", F.array(chunk).alias("evidence"), F.lit(0.75).alias("confidence"), F.col("day").alias("valid_from"))
    return temporal.supersede(now, staged).select("key", "weight", F.size("evidence").cast("long").alias("n_evidence"), "valid_from", "valid_to", "is_current")


@query(
    """WITH e AS (SELECT user_id || ':' || event_type AS key, 'c_' || event_id AS chunk, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0.5 ELSE 0.75 END AS confidence FROM events)
SELECT key, string_agg(DISTINCT chunk, '>' ORDER BY chunk) AS evidence, max(confidence)::DOUBLE AS confidence FROM e GROUP BY key"""
)
def edge_merge_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("key", F.concat_ws(":", "user_id", "event_type"))
    edges = lambda rows, confidence: rows.groupBy("key").agg(F.collect_set(F.concat(F.lit("c_"), "event_id")).alias("evidence"), F.lit(confidence).alias("confidence"))
    merged = temporal.accrete(edges(e.where("ts < TIMESTAMP'2024-01-16'"), 0.5), edges(e.where("ts >= TIMESTAMP'2024-01-16'"), 0.75))
    return merged.withColumn("evidence", F.array_join("evidence", ">"))


@query(
    """WITH e AS (SELECT user_id || ':' || event_type AS key, ts < TIMESTAMP '2024-01-16' AS early, event_type, value, CAST(ts AS DATE) AS day FROM events),
t AS (SELECT key, CASE WHEN event_type = 'click' THEN 1.0::DOUBLE ELSE max(value) END AS w, min(day) AS f, count(*) AS n FROM e WHERE early GROUP BY key, event_type),
s AS (SELECT key, CASE WHEN event_type = 'click' THEN 1.0::DOUBLE ELSE max(value) END AS w, min(day) AS f, count(*) AS n FROM e WHERE NOT early GROUP BY key, event_type),
b AS (SELECT coalesce(t.key, s.key) AS key, t.w AS tw, t.f AS tf, t.n AS tn, s.w AS sw, s.f AS sf, s.n AS sn, t.key IS NULL AS fresh, s.key IS NOT NULL AND s.w IS DISTINCT FROM t.w AND s.f > t.f AS changed FROM t FULL JOIN s ON t.key = s.key)
SELECT key, sw AS weight, sn AS n_evidence, sf AS valid_from, CAST(NULL AS DATE) AS valid_to, true AS is_current FROM b WHERE fresh OR changed
UNION ALL SELECT key, tw, tn, tf, sf, false FROM b WHERE changed AND NOT fresh
UNION ALL SELECT key, tw, tn + coalesce(sn, 0), tf, NULL, true FROM b WHERE NOT fresh AND NOT coalesce(changed, false)"""
)
def edge_supersede(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later weight closes an edge; the same weight (clicks) adds evidence only."""
    e = table(spark, sf_dir, "events").select(F.concat_ws(":", "user_id", "event_type").alias("key"), "event_type", "event_id", "value", "ts")

    def edges(rows: DataFrame, confidence: float) -> DataFrame:
        made = rows.groupBy("key", "event_type").agg(F.max("value").alias("most"), F.min(F.to_date("ts")).alias("valid_from"), F.collect_set(F.concat(F.lit("c_"), "event_id")).alias("evidence"))
        return made.select("key", F.when(F.col("event_type") == "click", 1.0).otherwise(F.col("most")).alias("weight"), "evidence", F.lit(confidence).alias("confidence"), "valid_from")

    now = edges(e.where("ts < TIMESTAMP'2024-01-16'"), 0.5).withColumns({"valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    merged = temporal.supersede(now, edges(e.where("ts >= TIMESTAMP'2024-01-16'"), 0.75))
    return merged.select("key", "weight", F.size("evidence").cast("long").alias("n_evidence"), "valid_from", "valid_to", "is_current")


def _changed(d1: str, d2: str) -> str:
    return f", b AS (SELECT key, value FROM versions WHERE {HOLDS.format(d=d1)}), a AS (SELECT key, value FROM versions WHERE {HOLDS.format(d=d2)})"


@query(
    VERSIONS + _changed("2024-01-03", "2024-01-20") + """ SELECT coalesce(b.key, a.key) AS key, b.value AS before, a.value AS after,
  CASE WHEN b.value IS NULL THEN 'insert' WHEN a.value IS NULL THEN 'delete' ELSE 'update' END AS change FROM b FULL JOIN a ON a.key = b.key WHERE b.value IS DISTINCT FROM a.value"""
)
def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _versions(spark, sf_dir)
    return temporal.change_feed(temporal.as_of(versions, "2024-01-03"), temporal.as_of(versions, "2024-01-20"), "key", "value")


@query(
    VERSIONS + _changed("2024-01-03", "2024-01-20").replace("SELECT key, value", "SELECT key, CASE WHEN event_id % 3 <> 0 THEN value END AS value") + """ SELECT coalesce(b.key, a.key) AS key, b.value AS before, a.value AS after,
  CASE WHEN b.key IS NULL THEN 'insert' WHEN a.key IS NULL THEN 'delete' ELSE 'update' END AS change FROM b FULL JOIN a ON a.key = b.key WHERE b.key IS NULL OR a.key IS NULL OR b.value IS DISTINCT FROM a.value"""
)
def change_feed_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the contents are null: to and from null is an update, not an insert or a delete."""
    versions = _versions(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 3 != 0, F.col("value")))
    return temporal.change_feed(temporal.as_of(versions, "2024-01-03"), temporal.as_of(versions, "2024-01-20"), "key", "value")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY user_id")
def cdc_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.latest_change(table(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id"), "user_id", "event_id")


@query(GRAPH + "SELECT edge_type, count(*) AS n FROM edges WHERE (valid_to IS NULL OR valid_from >= DATE '2001-06-01' - 730) AND edge_type IN ('LOCATED_IN', 'EXPOSED_TO') GROUP BY 1")
def hot_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return temporal.hot(builders.edges(spark, sf_dir), "2001-06-01", 730, ["LOCATED_IN", "EXPOSED_TO"]).groupBy("edge_type").agg(F.count("*").alias("n"))
