"""Ways to write a table: whole, appended, by partition, by key. Tables are Parquet folders; writers are Spark's own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import workspace


def new_path(spark: SparkSession, name: str) -> str:
    return f"{workspace(spark)}/{name}-{uuid.uuid4().hex}"


def overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def replace_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Replaces the partitions that occur in rows, and no others: snapshots by date or run stay beside each other."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def replace_snapshot(rows: DataFrame, path: str, by: str, value: str) -> None:
    """Replaces one partition of a table of snapshots: one without rows is there, too, and takes the place of the one before."""
    rows.drop(by).write.mode("overwrite").parquet(f"{path}/{by}={value}")


def snapshots(spark: SparkSession, path: str, by: str) -> list[str]:
    """The values of ``by`` for which a table has snapshots, empty ones among them, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)]
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{by}="))


def keep_latest(spark: SparkSession, path: str, by: str, most: int = 8) -> list[str]:
    """Of a table of snapshots, one partition ``by`` each, the latest ``most`` stay; the values that went, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(f.getPath().getName() for f in fs.listStatus(at) if f.getPath().getName().startswith(f"{by}="))
    gone = names[: max(0, len(names) - most)]
    for name in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(at, name), True)
    return [n.partition("=")[2] for n in gone]


def merged(old: DataFrame, new: DataFrame, key: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Update-or-insert by key: new rows replace old ones, but in ``keep`` a null never replaces a value. New rows are one a key."""
    both = old.select(*[F.col(c).alias(f"o_{c}") for c in old.columns]).join(new.withColumn("n_here", F.lit(True)), F.col(f"o_{key}") == F.col(key), "full")
    pick = lambda c: F.coalesce(c, f"o_{c}") if c in keep or c == key else F.when(F.col("n_here"), F.col(c)).otherwise(F.col(f"o_{c}"))
    return both.select(*[pick(c).alias(c) for c in old.columns])


def replaced(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Old rows whose keys aren't among the new ones, and all new rows; a column that one side alone has is empty in the other's rows."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def reclaimed(rows: DataFrame, path: str, *columns: str) -> DataFrame:
    """Writes a table anew with these columns empty, under the same schema: their space is free once the old files go."""
    rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name in columns else F.col(f.name) for f in rows.schema]).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def added(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are not there yet, each once."""
    return old.unionByName(new.dropDuplicates(list(keys)).join(old.select(*keys), list(keys), "left_anti"))


def served(changes: DataFrame, table: DataFrame, key: str, order: str, live: str = "is_current", keep: tuple[str, ...] = ()) -> DataFrame:
    """Applies a change log to a served table: of each key the last change counts; a closed one deletes, any other replaces."""
    last = changes.groupBy(key).agg(F.max_by(F.struct(*[c for c in changes.columns if c != key]), order).alias("c")).select(key, "c.*")
    left = table.join(last.where(~F.col(live)).select(key), key, "left_anti")
    return merged(left, last.where(F.col(live)).select(*table.columns), key, keep)
