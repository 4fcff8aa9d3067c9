"""Structured Streaming over event files: every job takes what is there (availableNow) and ends.

State is kept by Spark's checkpoints in the shared folder; results are tables there, replaced as a whole or by key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import dropped, stored, workspace


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event files as a stream; a table may be one file or a folder of them."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 64).parquet(f"{sf_dir}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))


def drained(stream: DataFrame, sink: Callable[[DataFrame, int], None], mode: str, at: str | None = None) -> None:
    """Runs a stream over all that is there. at: the folder of its checkpoint; a later run with the same one goes on where this one ended."""
    at = at or f"{workspace(stream.sparkSession)}/stream-{uuid.uuid4().hex}"
    stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()


def kept(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """The complete result of an aggregating stream, as of its last batch."""
    at = f"{workspace(spark)}/result-{uuid.uuid4().hex}"
    drained(stream, lambda df, i: df.write.mode("overwrite").parquet(f"{at}/{i}") if not df.isEmpty() else None, "complete")
    return spark.read.schema(stream.schema).option("recursiveFileLookup", "true").parquet(_last(spark, at))


def appended(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """All rows that a stream lets through, each batch under its own number, so that one that is run again replaces itself."""
    at = f"{workspace(spark)}/rows-{uuid.uuid4().hex}"
    drained(stream, lambda df, i: df.write.mode("overwrite").parquet(f"{at}/batch={i}"), "append")
    return spark.read.schema(stream.schema).parquet(at)


def _batches(spark: SparkSession, at: str) -> dict[int, str]:
    """The folders of a result whose batches were written to their end, by number."""
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    found = {f.getPath().getName(): f.getPath() for f in fs.listStatus(path)}
    return {int(n): p.toString() for n, p in found.items() if n.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))}


def _removed(spark: SparkSession, at: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _last(spark: SparkSession, at: str) -> str:
    found = _batches(spark, at)
    return found[max(found)]


def upserted(spark: SparkSession, stream: DataFrame, key: str, order: str, at: str | None = None, buckets: int = 64) -> DataFrame:
    """The latest row of each key over all batches (of equals the one of the largest hash).

    Rows lie in buckets by key. A batch reads and writes the buckets that it touches, in folders of its own, and ends with a list
    of which batch's folder each bucket is in; so a batch that is lost half-way leaves nothing that is seen, and one that is
    run again starts from the list before it. What neither of the last two lists names is removed.

    at: a shared folder that keeps checkpoint, buckets and lists; a later run (with the same number of buckets) goes on from
    there. Without it nothing outlives the application.
    """
    at, names = at or f"{workspace(spark)}/upsert-{uuid.uuid4().hex}", [c for c in stream.columns if c != key]
    plain = [f.name for f in stream.schema if f.name != key and "map<" not in f.dataType.simpleString()]
    latest = lambda rows: rows.groupBy(key).agg(F.max_by(F.struct(*names), F.struct(order, F.xxhash64(*plain))).alias("last")).select(key, "last.*")
    schema = latest(spark.createDataFrame([], stream.schema)).schema
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def listed(number: int) -> dict[int, int]:
        rows = spark.read.schema("bucket int, batch long").parquet(f"{at}/lists/{number}").collect()  # one a bucket
        return {r["bucket"]: r["batch"] for r in rows}

    def held(places: dict[int, int]) -> DataFrame:
        paths = [f"{at}/rows/batch={i}/bucket={b}" for b, i in places.items()]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def merge(df: DataFrame, i: int) -> None:
        earlier = sorted(j for j in _batches(spark, f"{at}/lists") if j < i)
        before = listed(earlier[-1]) if earlier else {}
        new = stored(latest(df), "upsert")
        touched = [r[0] for r in new.select(bucket).distinct().collect()]  # as many as there are buckets at most
        rows = latest(new.unionByName(held({b: j for b, j in before.items() if b in touched}))).withColumn("bucket", bucket)
        # some tasks a bucket, each with one file
        rows.repartition("bucket", F.pmod(F.xxhash64(F.lit(1), key), F.lit(8))).write.mode("overwrite").partitionBy("bucket").parquet(f"{at}/rows/batch={i}")
        now = sorted((before | dict.fromkeys(touched, i)).items())
        spark.createDataFrame(now, "bucket int, batch long").coalesce(1).write.mode("overwrite").parquet(f"{at}/lists/{i}")
        dropped(new)
        if len(earlier) > 1:
            for b, j in listed(earlier[-2]).items():
                if before[b] != j:
                    _removed(spark, f"{at}/rows/batch={j}/bucket={b}")
            _removed(spark, f"{at}/lists/{earlier[-2]}")

    drained(stream, merge, "append", f"{at}/checkpoint")
    done = _batches(spark, f"{at}/lists")
    return held(listed(max(done)) if done else {})


def tumbling(stream: DataFrame, size: str = "1 day", late: str = "2 days") -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("long")
    rows = stream.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum(cents).alias("cents"))
    return rows.select(F.col("window.start").alias("start"), "event_type", "n", "cents")


def sessions(stream: DataFrame, gap: str = "12 hours", late: str = "2 days") -> DataFrame:
    rows = stream.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))
    return rows.select("user_id", F.col("session_window.start").alias("start"), "n")


def on_time(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Events without repeats; a repeat that comes within the watermark is dropped."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
