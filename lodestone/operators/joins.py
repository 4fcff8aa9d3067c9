"""Joins that stand hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread_join(rows: DataFrame, facts: DataFrame, key: str | list[str], heavy: DataFrame) -> DataFrame:
    """rows join facts on ``key``, of which facts has one row each, or a few. heavy: the keys (a proven few) that very many rows share.

    What the heavy keys need is broadcast, so their rows stay where they are; all other rows are shuffled. Rows without a
    key find nothing.
    """
    heavy = F.broadcast(heavy.select(key).distinct())
    many = rows.join(F.broadcast(facts.join(heavy, key, "left_semi")), key)
    return many.unionByName(rows.join(heavy, key, "left_anti").join(facts, key))


def heavy_keys(rows: DataFrame, key: str | list[str], least: int = 10_000, share: int = 1_000) -> DataFrame:
    """The keys that more than ``least`` rows and more than one in ``share`` rows have: fewer than ``share`` of them, whatever the table."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.join(F.broadcast(total), (F.col("n") > least) & (F.col("n") * share > F.col("total"))).select(key)
