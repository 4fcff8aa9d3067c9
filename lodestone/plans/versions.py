"""Queries: tables with versions, their change feeds, and what is served from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import closures, graph, temporal
from ..sources import builders, sinks
from ..sources.versions import Buckets, VersionedTable, sync, with_both_ends
from .registry import GRAPH, query, table
from .walks import CLOSED, DAY, HOLDS, _hot

#: States of a table: the last event of each user up to a day; users whose last event is an error are not in it.
STATES = ("2024-01-08", "2024-01-16", "2024-01-16", "2024-01-24", "2024-02-01")
STATES_SQL = "WITH " + ", ".join(
    f"s{i} AS (SELECT * FROM (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events WHERE ts < TIMESTAMP '{d}' GROUP BY user_id) WHERE event_type <> 'error')"
    for i, d in enumerate(dict.fromkeys(STATES))
) + ", none AS (SELECT * FROM s0 WHERE false), " + ", ".join(
    f"c{i} AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(b.event_id, a.event_id) AS event_id, coalesce(b.event_type, a.event_type) AS event_type, CASE WHEN a.user_id IS NULL THEN 'insert' WHEN b.user_id IS NULL THEN 'delete' ELSE 'update' END AS change, {i}::BIGINT AS version FROM {'none' if i == 0 else f's{i - 1}'} a FULL JOIN s{i} b ON a.user_id = b.user_id WHERE a.event_id IS DISTINCT FROM b.event_id)"
    for i in range(len(set(STATES)))
) + ", feed AS (" + " UNION ALL ".join(f"SELECT * FROM c{i}" for i in range(len(set(STATES)))) + ")"


def _state(spark: SparkSession, sf_dir: str, until: str) -> DataFrame:
    seen = table(spark, sf_dir, "events").where(F.col("ts") < F.lit(until).cast("timestamp"))
    return seen.groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type")).where("event_type != 'error'")


def _versioned(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """The same state twice makes no commit."""
    held = VersionedTable(spark, sinks.new_path(spark, "users"), "user_id", "user_id long, event_id long, event_type string", 16)
    for until in STATES:
        held.commit(_state(spark, sf_dir, until))
    return held


@query(STATES_SQL + " SELECT version, count(*) FILTER (change = 'insert') AS inserted, count(*) FILTER (change = 'update') AS updated, count(*) FILTER (change = 'delete') AS deleted FROM feed GROUP BY version")
def table_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a table's commits; its last row is the probe of its version."""
    return _versioned(spark, sf_dir).log().select("version", "inserted", "updated", "deleted")


@query(STATES_SQL + " SELECT user_id, event_id, event_type, change, version FROM feed WHERE version > 1")
def changes_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned(spark, sf_dir).changes_since(1)


@query(STATES_SQL + " SELECT user_id, event_id, event_type, (SELECT max(version) FROM feed f WHERE f.user_id = s.user_id) AS version FROM s3 s WHERE event_type IN ('click', 'view')")
def served_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A served table of clickers and viewers follows its source: commit by commit, then not for two of them, then twice over."""
    source = VersionedTable(spark, sinks.new_path(spark, "users"), "user_id", "user_id long, event_id long, event_type string", 16)
    served = Buckets(spark, sinks.new_path(spark, "served"), "user_id", "user_id long, event_id long, event_type string", 16)
    shown = F.col("event_type").isin("click", "view")
    for i, until in enumerate(STATES):
        source.commit(_state(spark, sf_dir, until))
        if i in (0, 1, 4):
            sync(source, served, "server", shown)
    sync(source, served, "server", shown)
    return served.rows().select("user_id", "event_id", "event_type", "version")


@query(
    GRAPH + f""", held AS (SELECT * FROM edges WHERE {HOLDS} AND edge_type IN ('EXPOSED_TO', 'LOCATED_IN')), there AS (SELECT node_id FROM nodes WHERE masking_tier <= 1)
SELECT edge_type, src IN (SELECT node_id FROM there) AND dst IN (SELECT node_id FROM there) AS served, count(*) AS n, min(edge_id) AS first_id FROM held GROUP BY 1, 2"""
)
def edges_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges come before some of their ends: what can't be served yet waits, and isn't lost."""
    nodes, held = builders.nodes(spark, sf_dir), temporal.as_of(builders.edges(spark, sf_dir), DAY).where("edge_type IN ('EXPOSED_TO', 'LOCATED_IN')")
    store = Buckets(spark, sinks.new_path(spark, "edges"), "edge_id", "edge_id string, src string, dst string, edge_type string, weight double", 16)
    store.put(held.withColumns({"live": F.lit(True), "version": F.lit(0).cast("long")}))
    able, waiting = with_both_ends(store.rows(), nodes.where("masking_tier <= 1"))
    both = able.withColumn("served", F.lit(True)).unionByName(waiting.withColumn("served", F.lit(False)))
    return both.groupBy("edge_type", "served").agg(F.count("*").alias("n"), F.min("edge_id").alias("first_id"))


BEFORE = "1997-12-28"


@query(CLOSED + " SELECT src, dst, hops, weight, path FROM closed")
def closure_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closure of a day, made from that of four days before and the edges that came, went or changed since."""
    old, new = _hot(spark, sf_dir, day=BEFORE)[0], _hot(spark, sf_dir)[0]
    return closures.updated(graph.closure(old, 3), old, new, 3).withColumn("path", F.array_join("path", ">"))


@query(
    "WITH after_ AS (" + CLOSED + " SELECT src, dst, hops, weight, path FROM closed), before_ AS (" + CLOSED.replace(f"DATE '{DAY}'", f"DATE '{BEFORE}'") + """ SELECT src, dst, hops, weight, path FROM closed),
d AS (SELECT CASE WHEN b.src IS NULL THEN 'insert' WHEN a.src IS NULL THEN 'delete' ELSE 'update' END AS change, coalesce(a.hops, b.hops) AS hops, coalesce(a.src, b.src) AS src
FROM before_ b FULL JOIN after_ a ON a.src = b.src AND a.dst = b.dst WHERE a.path IS DISTINCT FROM b.path OR a.weight IS DISTINCT FROM b.weight)
SELECT change, hops, count(*) AS n, min(src) AS first_src FROM d GROUP BY 1, 2"""
)
def closure_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the pairs that an update changes, by kind and hops."""
    old, new = _hot(spark, sf_dir, day=BEFORE)[0], _hot(spark, sf_dir)[0]
    before = graph.closure(old, 3)
    return closures.delta(before, closures.updated(before, old, new, 3)).groupBy("change", "hops").agg(F.count("*").alias("n"), F.min("src").alias("first_src"))
