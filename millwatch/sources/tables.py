"""Parquet tables of the service: exact schemas, appends and idempotent batch writes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


# Column that puts each table's newest rows first, for display.
NEWEST_BY = {
    "readings": "timestamp",
    "failures": "start_time",
    "clusters": "created_at",
    "predictions": "prediction_time",
    "drift": "detection_time",
}


def newest_first(df: DataFrame, table: str) -> DataFrame:
    """Rows in the table's display order; sort what is shown, not what is computed with."""
    return df.orderBy(F.col(NEWEST_BY[table]).desc())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Selects the schema's columns in order and type; absent columns become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def append(df: DataFrame, path: str, schema: T.StructType) -> None:
    conform(df, schema).write.mode("append").parquet(path)


def write_batch(
    df: DataFrame, path: str, batch_id: int, schema: T.StructType, by_date: str | None = None
) -> None:
    """Writes one micro-batch under its own id, so that a repeated batch replaces itself.

    With ``by_date`` the table is laid out by day first, which lets time filters skip days.
    """
    out = conform(df, schema).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    layout = ["batch_id"]
    if by_date:
        out = out.withColumn("date", F.to_date(by_date))
        layout = ["date", "batch_id"]
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout)
        .parquet(path)
    )


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared scratch folder and reads it back.

    What follows reads a finished table instead of recomputing its history, also after
    executors were lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with its declared schema; empty when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, by_date: bool = False
) -> DataFrame:
    """A table written by :func:`write_batch`, with ``batch_id`` and, if asked, ``date``."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return read(spark, path, full.add("date", T.DateType()) if by_date else full)


def read_batch(
    spark: SparkSession, path: str, schema: T.StructType, batch_id: int, by_date: bool = False
) -> DataFrame:
    """One micro-batch of such a table, without listing the others."""
    part = f"{path}/date=*/batch_id={batch_id}" if by_date else f"{path}/batch_id={batch_id}"
    return read(spark, part, schema)


def days_of(df: DataFrame, ts: str = "timestamp") -> list[str]:
    """The days that rows of one micro-batch fall on."""
    days = df.select(F.to_date(ts).alias("d")).filter("d is not null").distinct().collect()
    return sorted(r["d"].isoformat() for r in days)


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, days: list[str], batch_id: int | None = None
) -> DataFrame:
    """The given days of a table laid out by day, optionally one micro-batch of them.

    Only folders of these days are listed, so the work does not grow with the age of the table.
    """
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    full = full.add("date", T.DateType())
    part = "" if batch_id is None else f"/batch_id={batch_id}"
    folders = [f"{path}/date={day}{part}" for day in days]
    conf = spark._jsc.hadoopConfiguration()
    at = spark._jvm.org.apache.hadoop.fs.Path
    there = [f for f in folders if at(f).getFileSystem(conf).exists(at(f))]
    if not there:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*there)


def slot(path: str, batch_id: int) -> str:
    """Folder of the state after a micro-batch.

    Two folders alternate: a micro-batch reads one and replaces the other, so a repeated one
    still finds what it read before.
    """
    return f"{path}/slot={batch_id % 2}"


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
