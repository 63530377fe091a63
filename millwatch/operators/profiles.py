"""Profiles of a wide, partly labeled reference table: one pass each, small results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import (
    DEFAULT_LABEL_PATTERNS,
    DEFAULT_SENSOR_PROFILE,
    DEFAULT_SENSORS,
    SENSOR_PREFIX,
)
from ..functions.sensors import clamp_to_profile, sensor_columns
from ..sources.labeled import labeled_rows

_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def sensor_profile(df: DataFrame) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per sensor over all rows."""
    return _stats_per_sensor(df, [], ["mean", "std", "min", "max"])


def label_pattern(df: DataFrame) -> DataFrame:
    """Mean and sample deviation per label and sensor; a statistic without value counts as 0."""
    stats = _stats_per_sensor(labeled_rows(df), ["Label"], ["mean", "std"])
    return stats.select(
        F.col("Label").alias("label"),
        "sensor",
        F.coalesce("mean", F.lit(0.0)).alias("mean"),
        F.coalesce("std", F.lit(0.0)).alias("std"),
    )


def label_inventory(df: DataFrame) -> DataFrame:
    """Number of labeled rows and of distinct labels."""
    return labeled_rows(df).agg(
        F.count(F.lit(1)).alias("n_labeled"), F.count_distinct("Label").alias("n_labels")
    )


def default_sensor_profile(spark: SparkSession, n_sensors: int = DEFAULT_SENSORS) -> DataFrame:
    stats = [F.lit(v).alias(k) for k, v in DEFAULT_SENSOR_PROFILE.items()]
    return spark.range(n_sensors).select(_default_name("id"), *stats)


def default_label_pattern(spark: SparkSession, n_sensors: int = DEFAULT_SENSORS) -> DataFrame:
    patterns = F.array(
        *[
            F.struct(F.lit(label).alias("label"), F.lit(mean).alias("mean"), F.lit(std).alias("std"))
            for label, (mean, std) in DEFAULT_LABEL_PATTERNS.items()
        ]
    )
    return spark.range(n_sensors).select(_default_name("id"), F.inline(patterns))


def or_default(found: DataFrame, default: DataFrame) -> DataFrame:
    """``found`` unless it is empty or holds a statistic without value, then ``default``.

    Decided inside the plan: the default rows appear only when ``found`` has none to offer.
    """
    missing = F.lit(False)
    for name in ("mean", "std", "min", "max"):
        if name in found.columns:
            missing = missing | F.col(name).isNull()
    flawed = found.agg(
        ((F.count(F.lit(1)) == 0) | F.coalesce(F.bool_or(missing), F.lit(False))).alias("flawed")
    )
    return found.filter(~flawed.scalar()).unionByName(
        default.select(found.columns).filter(flawed.scalar())
    )


def clamp_readings(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Clamps long readings ``(…, sensor, value)`` to the sensor profile.

    The profile has one row per sensor; how it is joined is left to its size.
    """
    bounds = profile.select("sensor", F.col("min").alias("_low"), F.col("max").alias("_high"))
    return (
        df.join(bounds, "sensor")
        .withColumn("value", clamp_to_profile(F.col("value"), F.col("_low"), F.col("_high")))
        .drop("_low", "_high")
    )


def _stats_per_sensor(df: DataFrame, keys: Sequence[str], stats: Sequence[str]) -> DataFrame:
    """All statistics of all sensor columns in one aggregation, then one row per sensor."""
    names = sensor_columns(df)
    packed = [
        F.struct(F.lit(name).alias("sensor"), *[_STATS[s](f"`{name}`").alias(s) for s in stats])
        for name in names
    ]
    return df.groupBy(*keys).agg(F.array(*packed).alias("_all")).select(*keys, F.inline("_all"))


def _default_name(index: str) -> Column:
    return F.concat(F.lit(f"{SENSOR_PREFIX} "), F.col(index).cast("string")).alias("sensor")
