"""Queries on drift; the kind of a normal event stands for its predicted cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift as dr
from ..operators import scoring as sc
from ..sources import tables
from . import driver_views as views
from .catalog import query
from .on_ingest import as_of, r6

# Kinds of normal events, by stand-in cluster id.
KINDS = ("click", "purchase", "signup", "view")
K = len(KINDS)
WINDOW = 10
THRESHOLD = 0.0005

_CASE = " ".join(f"WHEN '{kind}' THEN {i}" for i, kind in enumerate(KINDS))
PREDICTED_SQL = f"""predicted AS (
  SELECT event_id AS reading_id, ts, CASE event_type {_CASE} END AS cluster_id,
         (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS batch_no
  FROM events WHERE event_type <> 'error')"""


def series_sql(k: int, window: int) -> str:
    """``dist``, ``reference``, ``rolled`` and ``scores`` from ``predicted(batch_no, cluster_id)``.

    There is no reference, and every score is 0, until the first window is full.
    """
    return f"""grid AS (SELECT DISTINCT batch_no, c AS cluster_id FROM predicted, range({k}) t(c)),
counts AS (SELECT batch_no, cluster_id, count(*) AS n FROM predicted GROUP BY ALL),
dist AS MATERIALIZED (
  SELECT g.batch_no, g.cluster_id,
         coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY g.batch_no) AS freq
  FROM grid g LEFT JOIN counts c ON c.batch_no = g.batch_no AND c.cluster_id = g.cluster_id),
reference AS MATERIALIZED (
  SELECT cluster_id, sum(freq) / {window} AS freq FROM dist WHERE batch_no < {window}
  GROUP BY cluster_id HAVING count(*) = {window}),
rolled AS (
  SELECT batch_no, cluster_id, avg(freq) OVER (
           PARTITION BY cluster_id ORDER BY batch_no ROWS {window - 1} PRECEDING) AS freq
  FROM dist),
both_sides AS (
  SELECT w.batch_no, w.freq AS p, r.freq AS q, (w.freq + r.freq) / 2 AS m
  FROM rolled w LEFT JOIN reference r USING (cluster_id)),
scores AS MATERIALIZED (
  SELECT batch_no,
         CASE WHEN batch_no < {window - 1} THEN 0.0 ELSE least(1.0, greatest(0.0,
           (sum(CASE WHEN p > 0 AND m > 0 THEN p * ln(p / m) ELSE 0 END)
            + sum(CASE WHEN q > 0 AND m > 0 THEN q * ln(q / m) ELSE 0 END)) / 2)) END AS score
  FROM both_sides GROUP BY batch_no)"""


SERIES_SQL = f"{PREDICTED_SQL},\n{series_sql(K, WINDOW)}"


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal readings with a stand-in cluster."""
    kind = F.col("event_type")
    cluster = F.array_position(F.lit(list(KINDS)), kind) - 1
    return (
        views.table(spark, sf_dir, "events")
        .filter(kind != "error")
        .select(
            F.col("event_id").alias("reading_id"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            cluster.cast("int").alias("cluster_id"),
            (F.col("value") / 200).alias("latency"),
        )
    )


def distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: the series reads them twice, for the window and for the reference."""
    found = dr.batch_distribution(sc.with_batch_no(predicted(spark, sf_dir)), K)
    return tables.materialise(found, "distributions")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dr.drift_series(distributions(spark, sf_dir), K, WINDOW, THRESHOLD)


@query(
    f"""WITH {PREDICTED_SQL}
SELECT CAST(batch_no AS BIGINT) AS batch_no, CAST(cluster_id AS INT) AS cluster_id,
       CAST(sum(count(*)) OVER (PARTITION BY batch_no) AS BIGINT) AS n,
       round(count(*) / sum(count(*)) OVER (PARTITION BY batch_no), 6) AS freq
FROM predicted GROUP BY batch_no, cluster_id"""
)
def batch_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dr.distribution_long(distributions(spark, sf_dir)).select(
        "batch_no", "cluster_id", "n", r6("freq", "freq")
    )


@query(
    f"""WITH {SERIES_SQL}
SELECT CAST(cluster_id AS INT) AS cluster_id, round(freq, 6) AS freq FROM reference"""
)
def reference_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dr.reference_distribution(distributions(spark, sf_dir), K, WINDOW)
    return dr.distribution_long(found).select("cluster_id", r6("freq", "freq"))


@query(
    f"""WITH {SERIES_SQL}
SELECT CAST(batch_no AS BIGINT) AS batch_no, CAST(cluster_id AS INT) AS cluster_id,
       round(freq, 6) AS freq FROM rolled WHERE freq > 0"""
)
def window_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = dr.window_distribution(distributions(spark, sf_dir), K, WINDOW)
    return dr.distribution_long(rolled.select("batch_no", "window_freqs"), "window_freqs").select(
        "batch_no", "cluster_id", r6("freq", "freq")
    )


@query(
    f"""WITH {SERIES_SQL}
SELECT CAST(d.batch_no AS BIGINT) AS batch_no,
       round(sum(CASE WHEN r.freq IS NULL THEN NULL WHEN d.freq > 0 AND r.freq > 0 THEN d.freq * ln(d.freq / r.freq) ELSE 0 END), 6) AS kl
FROM dist d LEFT JOIN reference r USING (cluster_id) GROUP BY d.batch_no"""
)
def kl_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = series(spark, sf_dir)
    kl = dr.kl_divergence(F.col("freqs"), F.col("reference"))
    return rows.select("batch_no", r6(kl, "kl"))


@query(
    f"""WITH {SERIES_SQL}
SELECT CAST(batch_no AS BIGINT) AS batch_no, round(score, 6) AS drift_score,
       score > {THRESHOLD} AS is_drift FROM scores"""
)
def drift_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, sf_dir).select("batch_no", r6("drift_score", "drift_score"), "is_drift")


def events_sql(threshold: float) -> str:
    return f"""SELECT CAST(s.batch_no AS BIGINT) AS batch_no, round(s.score, 6) AS drift_score,
       CAST(d.cluster_id AS INT) AS cluster_id, round(d.freq, 6) AS current,
       round(r.freq, 6) AS reference
FROM scores s JOIN dist d USING (batch_no) JOIN reference r ON r.cluster_id = d.cluster_id
WHERE s.score > {threshold}"""


def events_long(events: DataFrame) -> DataFrame:
    return events.select(
        "batch_no",
        r6("drift_score", "drift_score"),
        F.explode("current_distribution").alias("cluster_id", "current"),
        "reference_distribution",
    ).select(
        "batch_no",
        "drift_score",
        "cluster_id",
        r6("current", "current"),
        r6(F.try_element_at("reference_distribution", F.col("cluster_id")), "reference"),
    )


@query(f"WITH {SERIES_SQL} {events_sql(THRESHOLD)}")
def drift_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_long(dr.drift_events(series(spark, sf_dir), as_of()))


@query(
    f"""WITH {PREDICTED_SQL},
p AS (SELECT cluster_id, count(*) / sum(count(*)) OVER () AS f FROM predicted WHERE cluster_id <= 2 GROUP BY 1),
q AS (SELECT cluster_id, count(*) / sum(count(*)) OVER () AS f FROM predicted WHERE cluster_id >= 1 GROUP BY 1)
SELECT CAST(cluster_id AS INT) AS cluster_id, round(coalesce(p.f, 0), 6) AS p, round(coalesce(q.f, 0), 6) AS q
FROM p FULL JOIN q USING (cluster_id)"""
)
def distribution_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distributions that each lack a cluster of the other."""
    rows = predicted(spark, sf_dir).withColumn("batch_no", F.lit(0))
    low = dr.batch_distribution(rows.filter("cluster_id <= 2"), K)
    high = dr.batch_distribution(rows.filter("cluster_id >= 1"), K)
    aligned = dr.align_distributions(dr.distribution_long(low), dr.distribution_long(high))
    return aligned.select("cluster_id", r6("p", "p"), r6("q", "q"))
