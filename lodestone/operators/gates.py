"""Data-quality gates and retrieval metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges of which either end is no node."""
    ids = nodes.select("node_id").distinct()
    known = lambda c: ids.select(F.col("node_id").alias(c), F.lit(True).alias(f"__{c}")).hint("shuffle_hash")  # noqa: E731  no sort of all edges
    # one pass over the edges, which may be dear to make
    rows = edges.join(known("src"), "src", "left").join(known("dst"), "dst", "left").where("__src IS NULL OR __dst IS NULL")
    return rows.select(*[f"`{c}`" for c in edges.columns])


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def overlaps(versions: DataFrame, key: str = "key") -> DataFrame:
    """Versions that are still valid when the next one of their key begins."""
    w = W.partitionBy(key).orderBy("valid_from", F.col("valid_to").asc_nulls_last())
    rows = versions.withColumn("next_from", F.lead("valid_from").over(w))
    return rows.where(F.col("next_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("next_from"))))


def gate(name: str, value: DataFrame | Column, limit: float) -> tuple[str, DataFrame | Column, float]:
    return name, value, limit


def rejected_share(audit: DataFrame, at: str, days: int = 7) -> DataFrame:
    """One row, value: of the last ``days`` days up to the log's latest one, how many of a hundred extracted things were rejected. audit: (n_nodes, n_edges, n_rejected, at)."""
    until = audit.agg(F.max(at).alias("until"))  # one row
    late = audit.join(F.broadcast(until), F.col(at) > F.col("until") - F.make_dt_interval(F.lit(days)))
    every = F.sum(F.col("n_nodes") + F.col("n_edges") + F.col("n_rejected"))
    return late.agg(F.coalesce(100.0 * F.sum("n_rejected") / F.greatest(every, F.lit(1)), F.lit(0.0)).alias("value"))


def ndcg_of(totals: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """query_id, ndcg: gains of true rows among the k first (1 / log2(rank + 1)) in parts of what the best order would gain. Inputs as those of recall_of; total of at least one."""
    gain = lambda rank: 1 / F.log2(rank + 1.0)
    got = hits.where(F.col("rank") <= k).groupBy("query_id").agg(F.sum(gain(F.col("rank"))).alias("got"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least("total", F.lit(k)).cast("int")), F.lit(0.0), lambda a, r: a + gain(r))
    return totals.join(got, "query_id", "left").select("query_id", (F.coalesce("got", F.lit(0.0)) / ideal).alias("ndcg"))


def evidence_coverage(relationships: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row, coverage: the share of relationships (relationship_id) with evidence (relationship_id); 1 if there are none."""
    held = evidence.select("relationship_id", F.lit(1).alias("held")).distinct()
    return relationships.join(held, "relationship_id", "left").agg(F.coalesce(F.count("held") / F.nullif(F.count("*"), F.lit(0)), F.lit(1.0)).alias("coverage"))


def report(gates: list[tuple[str, DataFrame, float]]) -> DataFrame:
    """gate, value, limit, passed: counts of rows that should not be there, or a table of one row and the column value."""
    worth = lambda rows: rows.select(F.col("value").cast("double")) if rows.columns == ["value"] else rows.agg(F.count("*").cast("double").alias("value"))
    parts = [worth(rows).select(F.lit(name).alias("gate"), "value", F.lit(float(limit)).alias("limit"), (F.col("value") <= limit).alias("passed")) for name, rows, limit in gates]
    return reduce(DataFrame.unionByName, parts)


def recall_at_k(truth: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """truth (query_id, id), found (query_id, id, rank) -> query_id, recall, precision, reciprocal rank of the first true one."""
    return recall_of(truth.groupBy("query_id").agg(F.count("*").alias("total")), found.join(truth, ["query_id", "id"]), k)


def recall_of(totals: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """As recall_at_k, from how many true rows a query has (query_id, total) and from the true ones among those found (query_id, rank)."""
    per = hits.where(F.col("rank") <= k).groupBy("query_id").agg(F.count("*").alias("hits"), (1.0 / F.min("rank")).alias("rr"))
    n = F.coalesce("hits", F.lit(0))
    return totals.join(per, "query_id", "left").select("query_id", (n / F.col("total")).alias("recall"), (n / F.lit(k)).alias("precision"), F.coalesce("rr", F.lit(0.0)).alias("rr"))
