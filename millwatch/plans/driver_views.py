"""The given tables seen as sensor data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings: one machine per user, failing on errors.

    ``Sensor 2`` is absent from every fourth kind of reading; ``Load`` is not a sensor.
    """
    k = F.regexp_extract("props", r'"k": *(\d+)', 1).cast("double")
    values = F.create_map(
        F.lit("Sensor 1"), F.col("value"),
        F.lit("Sensor 2"), F.when(k % 4 != 0, k),
        F.lit("Load"), k,
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("reading_id"),
        F.concat(F.lit("m"), F.col("user_id")).alias("machine_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.map_filter(values, lambda _, v: v.isNotNull()).alias("values"),
        (F.col("event_type") == "error").alias("has_failure"),
    )


READINGS_SQL = """readings AS (
  SELECT event_id AS reading_id, 'm' || CAST(user_id AS VARCHAR) AS machine_id, ts AS "timestamp",
         value AS s1,
         CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) % 4 <> 0
              THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS s2,
         CAST(json_extract(props, '$.k') AS DOUBLE) AS load,
         event_type = 'error' AS has_failure
  FROM events)"""


def wide_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a wide labeled table with four sensors; ``N`` lines carry no label."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("machine"),
        F.col("l_quantity").alias("Sensor 1"),
        F.col("l_extendedprice").alias("Sensor 2"),
        F.col("l_discount").alias("Sensor 3"),
        F.col("l_tax").alias("Sensor 4"),
        F.when(flag == "A", F.lit(1.0)).when(flag == "R", F.lit(2.0)).alias("Label"),
    )


WIDE_SQL = """wide AS (
  SELECT l_suppkey AS machine, l_quantity AS s1, l_extendedprice AS s2, l_discount AS s3,
         l_tax AS s4, CASE l_returnflag WHEN 'A' THEN 1.0 WHEN 'R' THEN 2.0 END AS label
  FROM lineitem)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as feature vectors."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("failure_id"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").cast("int").alias("cluster_id"),
    )
