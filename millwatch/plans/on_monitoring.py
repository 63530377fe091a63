"""Dashboard queries; a normal event is a prediction and its value sets the latency."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import monitoring as mo
from .catalog import query
from .on_drift import PREDICTED_SQL, SERIES_SQL, predicted, series
from .on_ingest import AS_OF, as_of, ntz, r6


@query(
    f"""WITH {PREDICTED_SQL}
SELECT date_trunc('minute', ts) AS minute, CAST(count(*) AS BIGINT) AS per_minute
FROM predicted GROUP BY 1"""
)
def rate_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = mo.rate_per_minute(predicted(spark, sf_dir))
    return rates.select(ntz("minute"), "per_minute")


@query(
    f"""WITH {PREDICTED_SQL},
placed AS (SELECT time_bucket(INTERVAL 15 SECOND, ts) - to_seconds(15 * i) AS minute
           FROM predicted, range(4) t(i))
SELECT minute, CAST(count(*) AS BIGINT) AS per_minute FROM placed GROUP BY minute"""
)
def rate_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = mo.rate_per_minute(predicted(spark, sf_dir), slide="15 seconds")
    return rates.select(ntz("minute"), "per_minute")


@query(
    f"""WITH {PREDICTED_SQL}
SELECT date_trunc('minute', ts) AS minute, CAST(cluster_id AS INT) AS cluster_id,
       CAST(count(*) AS BIGINT) AS per_minute
FROM predicted GROUP BY 1, 2"""
)
def rate_per_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series for every cluster."""
    rates = mo.rate_per_minute(predicted(spark, sf_dir), keys=["cluster_id"])
    return rates.select(ntz("minute"), "cluster_id", "per_minute")


@query(
    f"""WITH {PREDICTED_SQL},
m AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS n FROM predicted GROUP BY 1)
SELECT minute, CAST(n AS BIGINT) AS per_minute, CAST(sum(n) OVER (ORDER BY minute) AS BIGINT) AS total
FROM m"""
)
def cumulative_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = mo.cumulative_total(mo.rate_per_minute(predicted(spark, sf_dir)))
    return totals.select(ntz("minute"), "per_minute", "total")


@query(
    f"""WITH {PREDICTED_SQL}
SELECT CAST(cluster_id AS INT) AS cluster_id, CAST(count(*) AS BIGINT) AS n,
       round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM predicted GROUP BY cluster_id"""
)
def cluster_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mo.cluster_share(predicted(spark, sf_dir)).select("cluster_id", "n", r6("share", "share"))


def _bucket_rows(bounds: tuple[float, ...]) -> str:
    return ", ".join([*[f"('{b}', {b}::DOUBLE)" for b in bounds], "('+Inf', 'infinity'::DOUBLE)"])


def _histogram_sql(bounds: tuple[float, ...]) -> str:
    return f"""WITH lat AS (SELECT value / 200 AS latency FROM events WHERE event_type <> 'error'),
bounds(le, hi) AS (VALUES {_bucket_rows(bounds)}),
whole AS (SELECT sum(latency) AS s, count(*) AS c FROM lat)
SELECT le, CAST((SELECT count(*) FROM lat WHERE latency <= hi) AS BIGINT) AS n,
       round(s, 3) AS latency_sum, CAST(c AS BIGINT) AS latency_count FROM bounds, whole"""


def _histogram(spark: SparkSession, sf_dir: str, bounds: tuple[float, ...]) -> DataFrame:
    found = mo.latency_histogram(predicted(spark, sf_dir), bounds=bounds)
    rows = mo.histogram_rows(found, bounds)
    return rows.withColumn("latency_sum", F.round("latency_sum", 3))


@query(_histogram_sql(fixed.SCORING_LATENCY_BOUNDS))
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _histogram(spark, sf_dir, fixed.SCORING_LATENCY_BOUNDS)


@query(_histogram_sql(fixed.SENDING_LATENCY_BOUNDS))
def sending_latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _histogram(spark, sf_dir, fixed.SENDING_LATENCY_BOUNDS)


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predicted(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "timestamp"))
    return mo.latency_histogram(rows, keys=["hour"])


@query(
    """SELECT date_trunc('hour', ts) AS hour, round(avg(value / 200), 6) AS mean_latency
FROM events WHERE event_type <> 'error' GROUP BY 1"""
)
def latency_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mo.mean_latency(_hourly(spark, sf_dir)).select(
        ntz("hour"), r6("mean_latency", "mean_latency")
    )


def _quantile_sql(q: float) -> str:
    return f"""(SELECT CASE WHEN hi = 'infinity' THEN 1.0
        ELSE lo + (hi - lo) * ({q} * total - before) / (n - before) END
   FROM cum WHERE cum.hour = t.hour AND n >= {q} * total ORDER BY hi LIMIT 1)"""


_EDGES = ", ".join(
    f"({a}::DOUBLE, {b}::DOUBLE)"
    for a, b in zip((0.0, *fixed.SCORING_LATENCY_BOUNDS), fixed.SCORING_LATENCY_BOUNDS, strict=False)
)


@query(
    f"""WITH lat AS (SELECT date_trunc('hour', ts) AS hour, value / 200 AS latency
              FROM events WHERE event_type <> 'error'),
edges(lo, hi) AS (VALUES {_EDGES}, (1.0, 'infinity')),
cum AS MATERIALIZED (
  SELECT hour, lo, hi, count(*) FILTER (WHERE latency <= hi) AS n,
         count(*) FILTER (WHERE latency <= lo) AS before, count(*) AS total
  FROM lat, edges GROUP BY ALL)
SELECT t.hour, round(CAST({_quantile_sql(0.95)} AS DOUBLE), 6) AS p95,
       round(CAST({_quantile_sql(0.5)} AS DOUBLE), 6) AS p50
FROM (SELECT DISTINCT hour FROM lat) t"""
)
def latency_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = F.col("buckets")
    return _hourly(spark, sf_dir).select(
        ntz("hour"),
        r6(mo.histogram_quantile(buckets, 0.95), "p95"),
        r6(mo.histogram_quantile(buckets, 0.5), "p50"),
    )


@query(
    f"""WITH {SERIES_SQL}
SELECT round(arg_max(score, batch_no), 6) AS last_value, round(avg(score), 6) AS mean_value,
       round(max(score), 6) AS max_value FROM scores"""
)
def drift_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mo.series_summary(series(spark, sf_dir), "batch_no", "drift_score")
    return found.select(*[r6(c, c) for c in found.columns])


@query(
    """WITH per_hour AS (
  SELECT date_trunc('hour', ts) AS hour, avg(value / 200) AS latency, count(*) / 60.0 AS activity,
         avg(value / 200) / 4 AS drift
  FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT hour,
       CASE WHEN latency >= 0.2 THEN 'red' WHEN latency >= 0.1 THEN 'yellow' ELSE 'green' END AS latency_band,
       CASE WHEN activity >= 1 THEN 'green' WHEN activity >= 0.1 THEN 'yellow' ELSE 'red' END AS activity_band,
       CASE WHEN drift >= 0.1 THEN 'red' WHEN drift >= 0.05 THEN 'yellow' ELSE 'green' END AS drift_band
FROM per_hour"""
)
def threshold_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = mo.mean_latency(_hourly(spark, sf_dir))
    latency = F.col("mean_latency")
    return hours.select(
        ntz("hour"),
        mo.band(latency, fixed.LATENCY_BANDS).alias("latency_band"),
        mo.band(F.col("latency_count") / 60, fixed.ACTIVITY_BANDS).alias("activity_band"),
        mo.band(latency / 4, fixed.DRIFT_BANDS).alias("drift_band"),
    )


_RANGES = ", ".join(f"('{name}', {hours})" for name, hours in fixed.TIME_RANGES.items())


@query(
    f"""WITH {PREDICTED_SQL},
ranges(preset, hours) AS (VALUES {_RANGES})
SELECT preset, CAST(count(reading_id) AS BIGINT) AS n
FROM ranges LEFT JOIN predicted ON ts <= TIMESTAMP '{AS_OF}' AND ts >= TIMESTAMP '{AS_OF}' - to_hours(hours)
GROUP BY preset"""
)
def time_range_presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions inside each preset; one scan of the widest range serves them all."""
    widest = max(fixed.TIME_RANGES.values())
    rows = mo.trailing(predicted(spark, sf_dir), as_of(), widest)
    age = as_of() - F.col("timestamp")
    counts = [
        F.struct(
            F.lit(name).alias("preset"),
            F.count_if(age <= F.make_dt_interval(hours=F.lit(hours))).alias("n"),
        )
        for name, hours in fixed.TIME_RANGES.items()
    ]
    return rows.agg(F.array(*counts).alias("all")).select(F.inline("all"))
