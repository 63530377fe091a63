"""Intermediate tables and files in the shared scratch folder."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def keep(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes ``df`` to the shared folder and reads it back, with the path it lies at.

    The written table cuts the lineage: what follows never recomputes it, also after executors
    were lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes intermediate folders that no returned frame reads."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of stored and dropped plans now.

    It does so when the driver's JVM finds their plans to be garbage, which without this may
    take until long after the disk is full.
    """
    gc.collect()
    spark._jvm.System.gc()
