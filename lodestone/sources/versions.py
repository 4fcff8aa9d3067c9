"""Tables with versions: a log of commits beside the changes of each, read from a version on; consumers and their watermarks.

A commit is the difference between what the table held and what it is to hold. Its changes are one partition folder,
``changes/version=N``; then a line of the log, ``log``, makes them count, so a job that is lost in between leaves nothing
that is seen, and the next commit takes the same number again. A reader of later versions names their folders and opens no
others. The state of all keys is kept apart, ``state``, in buckets by key; a commit rewrites the buckets it touches. One
writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shared import dropped, stored

LOG = "version long, inserted long, updated long, deleted long, touched long, committed_at timestamp"
MARKS = "consumer string, version long, marked_at timestamp"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _rows(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


class Buckets:
    """Rows by key in folders ``bucket=B`` of a path; of a key the row of the largest ``version`` counts, and rows that are not ``live`` stay as marks.

    Writing rewrites the buckets of the new rows alone. Rows that come again change nothing.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, buckets: int = 64) -> None:
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.schema = StructType.fromDDL(f"{schema}, live boolean, version long")

    def _at(self, numbers: list[int]) -> DataFrame:
        """The rows of these buckets; of no other a file is opened."""
        paths = [p for b in numbers if _exists(self.spark, p := f"{self.path}/bucket={b}")]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def rows(self, marks: bool = False) -> DataFrame:
        """All live rows; with marks, those of deleted keys, too."""
        if not _exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(StructType([*self.schema, StructType.fromDDL("bucket int")[0]])).parquet(self.path).select(self.schema.names)
        return found if marks else found.where("live")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def put(self, rows: DataFrame, keep: tuple[str, ...] = ()) -> int:
        """Puts rows (as the schema says) in their places; in the columns ``keep`` a null never replaces a value. Returns how many buckets were rewritten."""
        rows = stored(rows.select(self.schema.names).withColumn("bucket", self.bucket()), "put")
        numbers = sorted(r[0] for r in rows.select("bucket").distinct().collect())  # as many as there are buckets at most
        if numbers:
            both = self._at(numbers).withColumn("bucket", self.bucket()).unionByName(rows)
            rest = [c for c in self.schema.names if c not in (self.key, "version")]
            last = F.max_by(F.struct(*rest), "version").alias("r")
            kept = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("version"))).alias(f"kept_{c}") for c in keep]
            one = both.groupBy(self.key, "bucket").agg(last, F.max("version").alias("version"), *kept)
            pick = lambda c: F.coalesce(f"r.{c}", f"kept_{c}").alias(c) if c in keep else F.col(f"r.{c}").alias(c)
            out = stored(one.select(self.key, *[pick(c) for c in rest], "version", "bucket").repartition("bucket"), "bucketed")
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)
            dropped(out)
        dropped(rows)
        return len(numbers)


class VersionedTable:
    """A table of rows by ``key``: ``schema`` names the key and all other columns."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, buckets: int = 64) -> None:
        self.spark, self.path, self.key = spark, path, key
        self.columns = StructType.fromDDL(schema)
        self.others = [c for c in self.columns.names if c != key]
        self.state = Buckets(spark, f"{path}/state", key, schema, buckets)
        self.changes_schema = StructType.fromDDL(f"{schema}, change string, version long")

    def log(self) -> DataFrame:
        """version, inserted, updated, deleted, touched (buckets), committed_at of each commit."""
        return _rows(self.spark, f"{self.path}/log", LOG)

    def version(self) -> int:
        """The last commit's number, from 0; -1 before the first. Reads the log alone."""
        found = self.log().agg(F.max("version")).first()[0]
        return -1 if found is None else found

    def snapshot(self) -> DataFrame:
        return self.state.rows().select(self.columns.names)

    def commit(self, rows: DataFrame, whole: bool = True) -> int:
        """Makes the table hold ``rows`` (one a key). Not ``whole``: other keys stay as they are. Returns the version; without any difference no new one is made.

        Null keys are left out. A null content is a content.
        """
        number, names = self.version() + 1, self.columns.names
        rows = stored(rows.select(names).where(F.col(self.key).isNotNull()), "commit")
        now = self.state.rows().where(F.col("version") < number)
        old = now.select(F.col(self.key).alias("__key"), F.struct(*self.others).alias("__old"))
        new = rows.select(self.key, F.struct(*self.others).alias("__new"))
        both = old.join(new, F.col("__key") == F.col(self.key), "full" if whole else "right")
        # structs are told apart by a hash of their text where they hold maps, which can't be compared
        same = F.to_json("__old").eqNullSafe(F.to_json("__new")) if any(f.dataType.typeName() == "map" for f in self.columns) else F.col("__old").eqNullSafe(F.col("__new"))
        kind = F.when(F.col("__key").isNull(), "insert").when(F.col(self.key).isNull(), "delete").when(~same, "update")
        both = both.withColumn("change", kind).where("change IS NOT NULL")
        value = lambda c: F.when(F.col("change") == "delete", F.col(f"__old.{c}")).otherwise(F.col(f"__new.{c}")).alias(c)
        out = both.select(F.coalesce(self.key, "__key").alias(self.key), *[value(c) for c in self.others], "change", F.lit(number).cast("long").alias("version"))
        at = f"{self.path}/changes/version={number}"
        out.select([*names, "change"]).write.mode("overwrite").parquet(at)
        done = self._changes([number])
        counts = {r["change"]: r["n"] for r in done.groupBy("change").agg(F.count("*").alias("n")).collect()}
        dropped(rows)
        if not counts:
            return number - 1
        touched = self.state.put(done.select(*names, (F.col("change") != "delete").alias("live"), "version"))
        line = self.spark.range(1).select(F.lit(number).cast("long").alias("version"), *[F.lit(counts.get(k, 0)).cast("long").alias(f"{k.removesuffix('e')}ed") for k in ("insert", "update", "delete")], F.lit(touched).cast("long").alias("touched"), F.current_timestamp().alias("committed_at"))
        line.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return number

    def _changes(self, versions: list[int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self.changes_schema)
        found = self.spark.read.schema(self.changes_schema).option("basePath", f"{self.path}/changes").parquet(*[f"{self.path}/changes/version={v}" for v in versions])
        return found.select(self.changes_schema.names)

    def changes_since(self, version: int) -> DataFrame:
        """key, columns, change (insert, update, delete), version of all commits after ``version``; only their files are listed and opened."""
        later = sorted(r["version"] for r in self.log().where(F.col("version") > version).select("version").collect())  # numbers of commits
        return self._changes(later)

    def watermark(self, consumer: str) -> int:
        """The version up to which a consumer has read; -1 at first."""
        found = _rows(self.spark, f"{self.path}/marks", MARKS).where(F.col("consumer") == consumer).agg(F.max("version")).first()[0]
        return -1 if found is None else found

    def set_watermark(self, consumer: str, version: int) -> None:
        line = self.spark.range(1).select(F.lit(consumer).alias("consumer"), F.lit(version).cast("long").alias("version"), F.current_timestamp().alias("marked_at"))
        line.coalesce(1).write.mode("append").parquet(f"{self.path}/marks")


def sync(source: VersionedTable, served: Buckets, consumer: str, where: Column | None = None, keep: tuple[str, ...] = ()) -> int:
    """Brings a served table up to its source: the changes after the consumer's watermark, of each key the last one. Returns how many buckets were rewritten.

    ``where`` says which rows are served; one that no longer is leaves. The watermark moves last, so that a lost run is
    done again, which changes nothing that it had done.
    """
    upto = source.version()
    changes = source.changes_since(source.watermark(consumer))
    shown = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    rest = [c for c in changes.columns if c not in (source.key, "version")]
    last = changes.groupBy(source.key).agg(F.max_by(F.struct(*rest), "version").alias("c"), F.max("version").alias("version")).select(source.key, "c.*", "version")
    touched = served.put(last.withColumn("live", (F.col("change") != "delete") & shown), keep)
    if upto > source.watermark(consumer):
        source.set_watermark(consumer, upto)
    return touched


def with_both_ends(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges that can be served, edges that wait): both ends are among the nodes (node_id), or not yet. Waiting edges stay in their table and are served once their ends have come."""
    ids = nodes.select("node_id")
    able = edges.join(ids.withColumnRenamed("node_id", "src"), "src", "left_semi").join(ids.withColumnRenamed("node_id", "dst"), "dst", "left_semi")
    return able, edges.join(able.select("edge_id"), "edge_id", "left_anti")
