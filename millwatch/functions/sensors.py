"""Expressions over the sensor values of a reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import VALUES
from .fixed import FEATURE_STATS, SENSOR_PREFIX


def sensor_columns(df: DataFrame) -> list[str]:
    """Sensor columns of a wide table; the prefix is case-sensitive."""
    return [name for name in df.columns if name.startswith(SENSOR_PREFIX)]


def sensor_values(values: Column) -> Column:
    """The entries of a value map that belong to sensors."""
    return F.map_filter(values, lambda name, _: name.startswith(SENSOR_PREFIX))


def parse_values(values: Column) -> Column:
    """A value map from its JSON text."""
    return F.from_json(values, VALUES)


def normalise_values(df: DataFrame, column: str = "values") -> DataFrame:
    """Brings ``column`` to a map whether it arrives as a map, a struct or JSON text."""
    kind = df.schema[column].dataType.typeName()
    if kind == "string":
        return df.withColumn(column, parse_values(F.col(column)))
    if kind == "struct":
        return df.withColumn(column, parse_values(F.to_json(column)))
    return df


def to_long(df: DataFrame, keys: Sequence[str], column: str = "values") -> DataFrame:
    """One row per reading and sensor."""
    return df.select(*keys, F.explode(sensor_values(F.col(column))).alias("sensor", "value"))


def wide_to_long(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per wide row and non-null sensor column."""
    names = sensor_columns(df)
    return df.unpivot(list(keys), names, "sensor", "value").filter(F.col("value").isNotNull())


def wide_to_map(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Collects the sensor columns of a wide table into a value map without nulls."""
    entries = [part for name in sensor_columns(df) for part in (F.lit(name), F.col(f"`{name}`"))]
    return df.select(
        *keys, F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull()).alias("values")
    )


def sensor_names(df: DataFrame, column: str = "values") -> DataFrame:
    """Distinct sensor names over all readings; one row per name."""
    return (
        df.select(F.explode(F.map_keys(column)).alias("sensor"))
        .filter(F.col("sensor").startswith(SENSOR_PREFIX))
        .distinct()
    )


def feature_names(sensors: Sequence[str]) -> list[str]:
    """Model features in order: the statistics of each sensor by name, then the duration."""
    names = [f"{s}_{stat}" for s in sorted(sensors) for stat in FEATURE_STATS]
    return [*names, "duration"]


def single_reading_source(feature: str, averaged: set[str]) -> str | None:
    """The value key a model feature reads when only one reading is known; None stands for 0.

    ``averaged`` holds the sensors whose ``_mean`` is a model feature: their mean, min and max
    are the value itself, their spread is 0. A lone ``_std``, ``_min`` or ``_max`` stays 0; any
    other name reads the key before its last underscore, or itself.
    """
    stem, cut, stat = feature.rpartition("_")
    if stat in FEATURE_STATS and stem in averaged:
        return None if stat == "std" else stem
    if any(f"_{s}" in feature for s in FEATURE_STATS):
        return None
    return stem if cut else feature


def single_reading_features(features: Sequence[str], values: Column) -> list[Column]:
    """The model's feature vector for one reading, in model order; missing keys give 0."""
    averaged = {f.partition("_mean")[0] for f in features if "_mean" in f}
    keys = [single_reading_source(f, averaged) for f in features]
    return [
        F.lit(0.0) if k is None else F.coalesce(F.try_element_at(values, F.lit(k)), F.lit(0.0))
        for k in keys
    ]


def clamp_to_profile(value: Column, low: Column, high: Column) -> Column:
    """Keeps a value within 1.2 times the profile's bounds, rounded to 6 places.

    With a positive minimum the factor raises the floor; that is intended.
    """
    return F.round(F.greatest(F.least(value, high * 1.2), low * 1.2), 6)

