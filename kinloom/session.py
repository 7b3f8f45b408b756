"""The shared work folder and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset, a session on one machine
    (a local master, as in tests) takes a temporary folder; on a cluster that would lose rows, so it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="kinloom-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under this application's name."""
    return f"{work_dir(spark)}/kinloom/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and returns a reader of it: lineage ends there, and a lost executor costs
    no more than a reread. ``release`` removes what a session has written."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._kinloom_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder of the shared store, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def discard(df: DataFrame) -> None:
    """Removes a materialized table that nothing will read again."""
    if path := getattr(df, "_kinloom_path", None):
        delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Removes every table that this application materialized. Call it when no result is read any more."""
    delete(spark, f"{work_dir(spark)}/kinloom/{spark.sparkContext.applicationId}")
