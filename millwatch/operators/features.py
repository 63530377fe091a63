"""Episode features: statistics per episode and sensor, ordered into vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import FEATURE_STATS, SENSOR_PREFIX
from ..functions.scale import bounded_rows
from ..functions.sensors import feature_names, sensor_values

MAX_SENSORS = 10_000

_KEY = ("machine_id", "failure_id")


def only_failing_values(readings: DataFrame) -> DataFrame:
    """Empties the values of normal readings.

    Episodes need the normal readings' times but not their values; applied before
    ``link_episodes`` this keeps most of the payload out of the shuffle.
    """
    return readings.withColumn("values", F.when(F.col("has_failure"), F.col("values")))


def episode_stats(linked: DataFrame) -> DataFrame:
    """Mean, population deviation, min and max per episode and sensor, plus the duration.

    The duration, the number of readings whatever sensors they hold, rides along as the rows of
    an unnamed sensor, so one aggregation gives both. Statistics are combined before the shuffle;
    an episode with most of the rows costs no more than any other.
    """
    sensors = F.map_filter(sensor_values(F.col("values")), lambda _, v: v.isNotNull())
    entries = F.concat(
        F.map_entries(sensors),
        F.array(F.struct(F.lit("").alias("key"), F.lit(0.0).alias("value"))),
    )
    return (
        linked.filter(F.col("failure_id").isNotNull())
        .select(*_KEY, F.inline(entries).alias("sensor", "value"))
        .groupBy(*_KEY, "sensor")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def stats_sensors(stats: DataFrame) -> list[str]:
    """Sensor names present in the episodes, in feature order."""
    found = stats.filter(F.col("sensor") != "").select("sensor").distinct()
    return sorted(row[0] for row in bounded_rows(found, MAX_SENSORS, "sensor names"))


def failing_sensors(readings: DataFrame) -> list[str]:
    """Sensor names over all failing readings, which are exactly the readings of episodes."""
    found = (
        readings.filter("has_failure")
        .select(F.explode(F.map_keys("values")).alias("sensor"))
        .filter(F.col("sensor").startswith(SENSOR_PREFIX))
        .distinct()
    )
    return sorted(row[0] for row in bounded_rows(found, MAX_SENSORS, "sensor names"))


def episode_vectors(stats: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """One row per episode with ``features`` in the order of :func:`feature_names`.

    A sensor that an episode never reported counts as 0 in all four statistics. The group
    collected per episode holds one row per sensor at most.
    """
    four = F.array(*[F.col(stat) for stat in FEATURE_STATS])
    by_sensor = F.map_from_entries(F.collect_list(F.struct("sensor", four.alias("stats"))))
    absent = F.array(*[F.lit(0.0) for _ in FEATURE_STATS])
    wanted = F.array(*[F.lit(s) for s in sorted(sensors)]).cast("array<string>")
    filled = F.transform(wanted, lambda s: F.coalesce(F.try_element_at("_by_sensor", s), absent))
    return (
        stats.groupBy(*_KEY)
        .agg(by_sensor.alias("_by_sensor"), F.max(F.when(F.col("sensor") == "", F.col("n"))).alias("_n"))
        .select(
            *_KEY,
            F.concat(F.flatten(filled), F.array(F.col("_n").cast("double"))).alias("features"),
        )
    )


def features_long(vectors: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per vector element with its position and name."""
    labels = F.array(*[F.lit(n) for n in names])
    keys = [c for c in vectors.columns if c != "features"]
    return vectors.select(*keys, F.posexplode("features").alias("feature_pos", "value")).withColumn(
        "feature", F.element_at(labels, F.col("feature_pos") + 1)
    )


def episode_features(linked: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Long feature table ``(machine_id, failure_id, feature_pos, feature, value)``."""
    vectors = episode_vectors(episode_stats(linked), sensors)
    return features_long(vectors, feature_names(sensors))
