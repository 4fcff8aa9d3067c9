"""Tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Where a session without spark.checkpoint.dir (tests, local use) keeps its shared tables.
_LOCAL: list[str] = []
_OPENED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir of the session, or, where that is unset and the driver runs the tasks itself, a temporary folder of this machine."""
    if found := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir"):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="lodestone-"))
        spark.sparkContext.setCheckpointDir(_LOCAL[0])
    return f"file://{_LOCAL[0]}"


def workspace(spark: SparkSession) -> str:
    """This application's own folder in the shared one. The driver's JVM removes it when it ends; until then whatever a query has returned can be read."""
    at = f"{shared_dir(spark)}/lodestone-{spark.sparkContext.applicationId}"
    if at not in _OPENED:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _OPENED.add(at)
    return at


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Writes a table into the shared folder and reads it back: this cuts the lineage, and a lost executor loses nothing."""
    path = f"{workspace(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Removes the files of a table made by stored() which nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if path.startswith(shared_dir(spark).replace("file:///", "file:/").rstrip("/")) or path.startswith(shared_dir(spark)):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
