"""The registry of queries: each with the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        @wraps(f)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = shipped
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_node_id(node_type: str, key: str) -> str:
    return f"('n_' || substr(sha1('{node_type}|' || upper({key})), 1, 20))"


def _sql_nodes() -> str:
    made = (
        ("Jurisdiction", "'R' || r_regionkey", "r_name", "''", 0, "region"),
        ("Jurisdiction", "'N' || n_nationkey", "n_name", "'region=R' || n_regionkey", 0, "nation"),
        ("Counterparty", "'C' || c_custkey", "c_name", "'country=N' || c_nationkey || ';segment=' || c_mktsegment", 2, "customer"),
        ("LegalEntity", "'S' || s_suppkey", "s_name", "'country=N' || s_nationkey", 0, "supplier"),
        ("Product", "'P' || p_partkey", "p_name", "'brand=' || p_brand", 1, "part"),
    )
    return " UNION ALL ".join(
        f"SELECT {sql_node_id(t, k)} AS node_id, '{t}' AS node_type, {n} AS name, {k} AS canonical_key, {p} AS properties, CAST({tier} AS INTEGER) AS masking_tier, '{s}' AS source_system, 1.0::DOUBLE AS confidence FROM {s}"
        for t, k, n, p, tier, s in made
    )


def _sql_edges() -> str:
    flat = (
        ("customer", "LOCATED_IN", sql_node_id("Counterparty", "'C' || c_custkey"), sql_node_id("Jurisdiction", "'N' || c_nationkey")),
        ("supplier", "LOCATED_IN", sql_node_id("LegalEntity", "'S' || s_suppkey"), sql_node_id("Jurisdiction", "'N' || s_nationkey")),
        ("nation", "ROLLS_UP_TO", sql_node_id("Jurisdiction", "'N' || n_nationkey"), sql_node_id("Jurisdiction", "'R' || n_regionkey")),
    )
    parts = [f"SELECT {a} AS src, {b} AS dst, '{t}' AS edge_type, 1.0::DOUBLE AS weight, DATE '1992-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to FROM {s}" for s, t, a, b in flat]
    sums = (
        ("EXPOSED_TO", "l_suppkey, o_custkey", sql_node_id("LegalEntity", "'S' || l_suppkey"), sql_node_id("Counterparty", "'C' || o_custkey"), "CAST(sum(CAST(round(l_extendedprice * (1 - l_discount) * 10000) AS BIGINT)) AS BIGINT)::DOUBLE / 10000.0::DOUBLE"),
        ("FUNDS", "l_partkey, l_suppkey", sql_node_id("Product", "'P' || l_partkey"), sql_node_id("LegalEntity", "'S' || l_suppkey"), "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT)::DOUBLE"),
    )
    parts += [
        f"SELECT {a} AS src, {b} AS dst, '{t}' AS edge_type, {w} AS weight, CAST(min(l_shipdate) AS DATE) AS valid_from, CAST(max(l_shipdate) AS DATE) + 1 AS valid_to FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY {keys}"
        for t, keys, a, b, w in sums
    ]
    return "SELECT 'e_' || substr(sha1(src || '|' || edge_type || '|' || dst || '|' || CAST(valid_from AS VARCHAR)), 1, 20) AS edge_id, 's_' || substr(sha1(src || '|' || edge_type || '|' || dst), 1, 20) AS series_id, src, dst, edge_type, weight, valid_from, valid_to, 1.0::DOUBLE AS confidence FROM (" + " UNION ALL ".join(parts) + ")"


#: Common table expressions for oracles; each oracle goes on with a comma or SELECT.
NODES = f"WITH RECURSIVE nodes AS ({_sql_nodes()}) "
GRAPH = f"WITH RECURSIVE nodes AS ({_sql_nodes()}), edges AS ({_sql_edges()}) "
#: Events as versions: one a user, type and day (the day's last event), valid until the next one.
VERSIONS = """WITH RECURSIVE daily AS (
  SELECT user_id || ':' || event_type AS key, CAST(ts AS DATE) AS valid_from, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY 1, 2),
versions AS (
  SELECT key, value, event_id, valid_from, lead(valid_from) OVER (PARTITION BY key ORDER BY valid_from) AS valid_to, valid_from + CAST(event_id % 3 AS INTEGER) AS recorded_at FROM daily) """
