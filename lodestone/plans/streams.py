"""Queries over the event stream (beyond the batch queries: windows, sessions, late and repeated events)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import jobs
from .registry import query


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.upserted(spark, jobs.events(spark, sf_dir).select("user_id", "event_type", "value", "event_id"), "user_id", "event_id")


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2")
def tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs.kept(spark, jobs.tumbling(jobs.events(spark, sf_dir)))
    return rows.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", "cents")


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 12 HOURS THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start, count(*) AS n FROM s GROUP BY user_id, no"""
)
def session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs.kept(spark, jobs.sessions(jobs.events(spark, sf_dir)))
    return rows.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start"), "n")


@query("SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type")
def late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = jobs.events(spark, sf_dir).select("event_id", "ts", "event_type")
    return jobs.appended(spark, jobs.on_time(once.unionByName(once), "1 hour")).groupBy("event_type").agg(F.count("*").alias("n"))
