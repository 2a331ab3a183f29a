"""Folders for intermediate tables that all executors can reach.

The root is ``spark.checkpoint.dir`` of the session; where that is unset (a
single machine, tests) it is a folder beside the session's warehouse. Tables
written here cut lineage and survive the loss of an executor.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the session, without a trailing slash."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared root that no other call returns."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`fresh_folder`."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are done with.

    It does so when the driver's JVM collects its garbage, by default twice an
    hour; a job of many steps would hold the files of all of them until then.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh folder and read it back.

    Later plans start from the files, so nothing above is computed twice, and
    the shuffle files behind them can go. The schema is passed on, so an empty frame stays readable.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)
