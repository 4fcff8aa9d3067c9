"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import heavy_keys, spread_join
from ..sources.shared import dropped, stored, workspace

__all__ = ["LOWER", "UPPER", "ascii_lower", "dropped", "fresh", "heavy_keys", "held_out", "row_keys", "spread_join", "stored", "table", "tidy", "totals_before", "workspace"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """The rows from which nothing is learnt: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fresh(columns: list[str], *names: str) -> list[str]:
    """These names, with as many underscores before each as it takes to be no column's."""
    taken, out = {c.lower() for c in columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
        taken.add(n.lower())
    return out


def row_keys(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """(id, k) of a row: its doc_id, null written as the smallest number, and a hash of id and text. Rows that agree in both are copies of one row."""
    d = F.col(doc_id)
    return F.coalesce(d.cast("long"), F.lit(-(2**63))), F.xxhash64(d, d.isNull(), F.col(text))


def totals_before(rows: DataFrame, by: list[str], order: str, value: str, name: str, block: int = 4_096) -> DataFrame:
    """rows with ``name``: the sum of ``value`` over the rows of the same ``by`` whose ``order`` (a whole number, unique) is smaller.

    In two steps, blocks of ``order`` first, so that a window never holds more rows than a block or than there are blocks.
    """
    at, sums = fresh([*rows.columns, name], "block", "sums")
    rows = rows.withColumn(at, F.floor(F.col(order) / block))
    blocks = rows.groupBy(*by, at).agg(F.sum(value).alias(sums))
    upto = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.select(*by, at, upto(sums, W.partitionBy(*by).orderBy(at)).alias(sums))
    rows = rows.join(blocks, [*by, at])
    return rows.withColumn(name, F.col(sums) + upto(value, W.partitionBy(*by, at).orderBy(order))).drop(at, sums)


try:
    _TRIM = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library
    _TRIM = None


def tidy() -> None:
    """Gives memory that a Python worker no longer uses back to the system; workers live on from task to task, and several share an executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)
