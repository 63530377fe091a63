"""Queries on decoding, episodes, reference profiles and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sensors import normalise_values, sensor_names, to_long, wide_to_long
from ..operators import clustering as cl
from ..operators import episodes as ep
from ..operators import features as ft
from ..operators import profiles as pf
from ..session import scratch_path
from ..sources import labeled, messages, tables
from . import driver_views as views
from .catalog import query
from .sql_parts import EPISODES_SQL, FEATURES_SQL, PATTERNS_SQL, SCALED_SQL, WIDE_LONG_SQL

AS_OF = "2024-01-31 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def r6(value: Column | str, name: str) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, 6).alias(name)


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.link_episodes(views.readings(spark, sf_dir))


def linked_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.link_episodes(ft.only_failing_values(views.readings(spark, sf_dir)))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as messages, with the faults a topic may carry; ``kind`` picks the fault."""
    kind = (F.col("reading_id") % 50).cast("int")
    rows = views.readings(spark, sf_dir)
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(
        F.when(kind != 4, F.col("values")).alias("readings"),
        F.when(~kind.isin(4, 5), F.col("has_failure")).alias("has_failure"),
    )
    message = F.to_json(
        F.struct(
            F.when(kind != 1, F.col("machine_id")).alias("machine_id"),
            F.when(kind == 2, "").when(kind == 3, "yesterday").otherwise(stamp).alias("timestamp"),
            F.when(kind != 7, body).alias("readings"),
        )
    )
    broken = (
        F.when(kind == 0, F.concat(F.lit("reading "), F.col("reading_id")))
        .when(kind == 6, F.regexp_replace(message, r'"Sensor 1":[^,}]*', '"Sensor 1":"n/a"'))
        .when(kind == 8, F.regexp_replace(message, r'"readings":\{"readings":\{[^}]*\}', '"readings":{"readings":"none"'))
    )
    return rows.select("reading_id", F.coalesce(broken, message).alias("value"))


@query(
    f"""WITH {EPISODES_SQL}
SELECT machine_id, failure_id, start_time, end_time, is_active, n_readings FROM failures"""
)
def episode_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.failures(linked(spark, sf_dir)).select(
        "machine_id", "failure_id", ntz("start_time"), ntz("end_time"), "is_active", "n_readings"
    )


@query(
    f"""WITH {FEATURES_SQL}
SELECT machine_id, failure_id, CAST(feature_pos AS INT) AS feature_pos, feature,
       round(value, 6) AS value FROM feats"""
)
def episode_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    sensors = ft.failing_sensors(views.readings(spark, sf_dir))
    return ft.episode_features(linked_failing(spark, sf_dir), sensors).select(
        "machine_id", "failure_id", "feature_pos", "feature", r6("value", "value")
    )


@query(
    """WITH r AS (SELECT *, event_id % 50 AS kind FROM events)
SELECT event_id AS reading_id, 'm' || CAST(user_id AS VARCHAR) AS machine_id, ts AS "timestamp",
       CASE WHEN kind IN (4, 6, 7) THEN NULL ELSE value END AS sensor_1,
       CASE WHEN kind IN (4, 5, 7) THEN false ELSE event_type = 'error' END AS has_failure,
       CAST(kind = 6 AS INT) AS n_bad_values
FROM r WHERE kind NOT IN (0, 1, 2, 3, 8)"""
)
def decode_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = messages.accepted(messages.decode(damaged_messages(spark, sf_dir)))
    return good.select(
        "reading_id",
        "machine_id",
        ntz("timestamp"),
        F.try_element_at("values", F.lit("Sensor 1")).alias("sensor_1"),
        "has_failure",
        "n_bad_values",
    )


@query(
    """SELECT CASE event_id % 50 WHEN 0 THEN 'not_json' WHEN 1 THEN 'missing_machine_id'
            WHEN 2 THEN 'missing_timestamp' WHEN 3 THEN 'bad_timestamp' WHEN 8 THEN 'bad_readings'
       END AS reason, CAST(count(*) AS BIGINT) AS n
FROM events WHERE event_id % 50 IN (0, 1, 2, 3, 8) GROUP BY 1"""
)
def rejected_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.rejected_by_reason(messages.decode(damaged_messages(spark, sf_dir)))


@query(
    """SELECT 'm' || CAST(user_id AS VARCHAR) AS machine_id, ts AS "timestamp", value AS sensor_1,
       CAST(json_extract(props, '$.k') AS DOUBLE) AS load, event_type = 'error' AS has_failure
FROM events"""
)
def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages.encode(views.readings(spark, sf_dir)).select("value")
    return messages.accepted(messages.decode(sent)).select(
        "machine_id",
        ntz("timestamp"),
        F.col("values")["Sensor 1"].alias("sensor_1"),
        F.col("values")["Load"].alias("load"),
        "has_failure",
    )


_VALUES_SQL = """SELECT event_id AS reading_id, 'Sensor 1' AS sensor, value FROM events
UNION ALL SELECT event_id, 'Sensor 2', CAST(json_extract(props, '$.k') AS DOUBLE) FROM events
WHERE CAST(json_extract(props, '$.k') AS BIGINT) % 4 <> 0"""


@query(_VALUES_SQL)
def normalised_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = views.readings(spark, sf_dir).withColumn("values", F.to_json("values"))
    return to_long(normalise_values(stored), ["reading_id"])


@query(_VALUES_SQL)
def sensors_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_long(views.readings(spark, sf_dir), ["reading_id"])


@query(
    """SELECT 'm' || CAST(user_id AS VARCHAR) AS machine_id, min(ts) AS first_seen, max(ts) AS last_seen
FROM events GROUP BY user_id"""
)
def machine_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.machines(views.readings(spark, sf_dir)).select(
        "machine_id", ntz("first_seen"), ntz("last_seen")
    )


@query(
    f"""WITH {EPISODES_SQL}
SELECT machine_id, CAST(count(*) AS BIGINT) AS n_started,
       CAST(count(*) FILTER (WHERE is_active) AS BIGINT) AS n_active
FROM failures GROUP BY machine_id"""
)
def failure_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ep.failure_counters(ep.failures(linked(spark, sf_dir)))


@query(
    f"""WITH {EPISODES_SQL}
SELECT machine_id, failure_id, start_time FROM failures ORDER BY start_time DESC"""
)
def newest_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = tables.newest_first(ep.failures(linked(spark, sf_dir)), "failures")
    return shown.select("machine_id", "failure_id", ntz("start_time"))


@query(
    f"""WITH {EPISODES_SQL}
SELECT r.reading_id, r.machine_id, m.failure_id
FROM readings r LEFT JOIN members m ON m.reading_id = r.reading_id"""
)
def reading_failure_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(spark, sf_dir).select("reading_id", "machine_id", "failure_id")


@query(
    f"""WITH {EPISODES_SQL}
SELECT machine_id, failure_id, start_time FROM failures
WHERE start_time >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR AND start_time < TIMESTAMP '{AS_OF}'"""
)
def lookback_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = ep.in_lookback(ep.failures(linked(spark, sf_dir)), as_of(), 168)
    return recent.select("machine_id", "failure_id", ntz("start_time"))


@query(
    f"""WITH {EPISODES_SQL},
spans AS (SELECT machine_id, max("timestamp") AS last_seen FROM readings GROUP BY machine_id)
SELECT m.machine_id, m.failure_id, m.reading_id, m.start_time, m."timestamp", s.last_seen
FROM members m JOIN spans s USING (machine_id)"""
)
def episode_readings_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    machines = ep.machines(views.readings(spark, sf_dir))
    joined = ep.episode_readings(None, linked(spark, sf_dir), machines)
    return joined.select(
        "machine_id",
        "failure_id",
        "reading_id",
        ntz("start_time"),
        ntz("timestamp"),
        ntz("last_seen"),
    )


@query(
    """SELECT 'Sensor 1' AS sensor FROM events UNION SELECT 'Sensor 2' FROM events
WHERE CAST(json_extract(props, '$.k') AS BIGINT) % 4 <> 0"""
)
def sensor_name_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_names(views.readings(spark, sf_dir))


@query(
    f"""WITH {WIDE_LONG_SQL}
SELECT sensor, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
       min(value) AS min, max(value) AS max FROM wide_long GROUP BY sensor"""
)
def sensor_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.sensor_profile(views.wide_readings(spark, sf_dir)).select(
        "sensor", r6("mean", "mean"), r6("std", "std"), "min", "max"
    )


_PATTERN_SQL = f"""WITH {PATTERNS_SQL}
SELECT CAST(label AS DOUBLE) AS label, sensor, round(mean, 6) AS mean, round(std, 6) AS std
FROM patterns"""


def _rounded_pattern(pattern: DataFrame) -> DataFrame:
    return pattern.select("label", "sensor", r6("mean", "mean"), r6("std", "std"))


@query(_PATTERN_SQL)
def label_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_pattern(pf.label_pattern(views.wide_readings(spark, sf_dir)))


@query(_PATTERN_SQL)
def label_pattern_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "labeled-csv")
    views.wide_readings(spark, sf_dir).write.csv(path, header=True)
    return _rounded_pattern(pf.label_pattern(labeled.read_labeled(spark, path)))


@query(
    """SELECT CAST(count(*) AS BIGINT) AS n_labeled,
       CAST(count(DISTINCT l_returnflag) AS BIGINT) AS n_labels
FROM lineitem WHERE l_returnflag IN ('A', 'R')"""
)
def label_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pf.label_inventory(views.wide_readings(spark, sf_dir))


@query(
    f"""WITH {WIDE_LONG_SQL},
profile AS (SELECT sensor, min(value) AS low, max(value) AS high
            FROM wide_long GROUP BY sensor),
clamped AS (
  SELECT machine, sensor, value,
         round(greatest(least(value, high * 1.2), low * 1.2), 6) AS held
  FROM wide_long JOIN profile USING (sensor))
SELECT machine, sensor, CAST(count(*) FILTER (WHERE held <> value) AS BIGINT) AS n_changed,
       round(sum(held), 3) AS total
FROM clamped GROUP BY machine, sensor"""
)
def profile_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = views.wide_readings(spark, sf_dir)
    profile = pf.sensor_profile(wide)
    readings = wide_to_long(wide, ["machine"]).withColumn("before", F.col("value"))
    return (
        pf.clamp_readings(readings, profile)
        .groupBy("machine", "sensor")
        .agg(
            F.count_if(F.col("value") != F.col("before")).alias("n_changed"),
            F.round(F.sum("value"), 3).alias("total"),
        )
    )


@query(
    f"""WITH {WIDE_LONG_SQL}
SELECT machine, sensor, CAST(count(*) AS BIGINT) AS n, round(sum(value), 3) AS total
FROM wide_long GROUP BY machine, sensor"""
)
def wide_to_long_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = wide_to_long(views.wide_readings(spark, sf_dir), ["machine"])
    return readings.groupBy("machine", "sensor").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total")
    )


def episode_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    sensors = ft.failing_sensors(views.readings(spark, sf_dir))
    return ft.episode_vectors(ft.episode_stats(linked_failing(spark, sf_dir)), sensors)


@query(
    f"""WITH {SCALED_SQL}
SELECT CAST(feature_pos AS INT) AS feature_pos, round(mean, 6) AS mean, round(scale, 6) AS scale
FROM scaler"""
)
def scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.scaler_stats(episode_vectors(spark, sf_dir)).select(
        "feature_pos", r6("mean", "mean"), r6("scale", "scale")
    )


@query(
    f"""WITH {SCALED_SQL}
SELECT id AS failure_id, CAST(pos AS INT) AS feature_pos, round(x, 6) AS value FROM points"""
)
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = episode_vectors(spark, sf_dir)
    mean, scale = cl.fit_scaler(vectors)
    return (
        cl.scale_vectors(vectors, mean, scale)
        .select("failure_id", F.posexplode("features").alias("feature_pos", "value"))
        .select("failure_id", "feature_pos", r6("value", "value"))
    )
