"""Queries on scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clustering as cl
from ..operators import describe as ds
from ..operators import scoring as sc
from ..sources import tables
from . import driver_views as views
from .catalog import query
from .driver_views import READINGS_SQL
from .on_ingest import as_of, episode_vectors, ntz
from .on_models import episode_model
from .sql_parts import FEATURES, MODEL_K, MODEL_ROUNDS, MODEL_SQL, nearest_sql


def past_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier predictions: views were scored by version 1, signups by version 2."""
    kind = F.col("event_type")
    return (
        views.table(spark, sf_dir, "events")
        .filter(kind.isin("view", "signup"))
        .select(
            F.col("event_id").alias("reading_id"),
            F.when(kind == "view", "1").otherwise("2").alias("model_version"),
        )
    )


PAST_SQL = """past AS (
  SELECT event_id AS reading_id, CASE event_type WHEN 'view' THEN '1' ELSE '2' END AS model_version
  FROM events WHERE event_type IN ('view', 'signup'))"""


@query(
    f"""WITH {READINGS_SQL}, {PAST_SQL}
SELECT reading_id, machine_id, "timestamp" FROM readings r
WHERE NOT has_failure AND NOT EXISTS (SELECT 1 FROM past p WHERE p.reading_id = r.reading_id)"""
)
def unscored_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = sc.unscored(views.readings(spark, sf_dir), past_predictions(spark, sf_dir))
    return left.select("reading_id", "machine_id", ntz("timestamp"))


@query(
    f"""WITH {READINGS_SQL}, {PAST_SQL}
SELECT reading_id, machine_id, "timestamp" FROM readings r
WHERE NOT has_failure
  AND NOT EXISTS (SELECT 1 FROM past p WHERE p.reading_id = r.reading_id AND p.model_version = '2')"""
)
def unscored_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = sc.unscored(
        views.readings(spark, sf_dir), past_predictions(spark, sf_dir), rescore_version="2"
    )
    return left.select("reading_id", "machine_id", ntz("timestamp"))


@query(
    f"""WITH {READINGS_SQL}, {PAST_SQL}
SELECT reading_id, "timestamp" FROM readings r
WHERE NOT has_failure AND NOT EXISTS (SELECT 1 FROM past p WHERE p.reading_id = r.reading_id)
ORDER BY "timestamp", reading_id LIMIT 100"""
)
def oldest_unscored_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = sc.unscored(views.readings(spark, sf_dir), past_predictions(spark, sf_dir))
    return sc.oldest(left).select("reading_id", ntz("timestamp"))


@query(
    f"""WITH {READINGS_SQL},
numbered AS (SELECT *, (row_number() OVER (ORDER BY "timestamp", reading_id) - 1) // 100 AS batch_no
             FROM readings WHERE NOT has_failure)
SELECT CAST(batch_no AS BIGINT) AS batch_no, reading_id FROM numbered"""
)
def scoring_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = views.readings(spark, sf_dir).filter(~F.col("has_failure"))
    return sc.with_batch_no(normal).select("batch_no", "reading_id")


_SINGLE = {
    "Sensor 1_mean": "s1", "Sensor 1_std": "0.0", "Sensor 1_min": "s1", "Sensor 1_max": "s1",
    "Sensor 2_mean": "coalesce(s2, 0.0)", "Sensor 2_std": "0.0",
    "Sensor 2_min": "coalesce(s2, 0.0)", "Sensor 2_max": "coalesce(s2, 0.0)",
    "duration": "0.0",
}
_VECTOR = ", ".join(
    f"CAST({_SINGLE[name]} AS DOUBLE) AS f{i}" for i, name in enumerate(FEATURES)
)


@query(
    f"""WITH {READINGS_SQL}
SELECT reading_id, {_VECTOR} FROM readings WHERE NOT has_failure"""
)
def single_reading_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = views.readings(spark, sf_dir).filter(~F.col("has_failure"))
    return normal.select("reading_id", sc.reading_vector(FEATURES).alias("x")).select(
        "reading_id", *[F.col("x")[i].alias(f"f{i}") for i in range(len(FEATURES))]
    )


_LONG_VECTOR = " UNION ALL ".join(
    f"SELECT reading_id AS id, {i} AS pos, CAST({_SINGLE[name]} AS DOUBLE) AS raw "
    "FROM readings WHERE NOT has_failure"
    for i, name in enumerate(FEATURES)
)
SCORED_SQL = f"""{MODEL_SQL},
vectors AS ({_LONG_VECTOR}),
new_points AS MATERIALIZED (
  SELECT id, pos, (raw - mean) / scale AS x FROM vectors JOIN scaler ON scaler.feature_pos = pos),
{nearest_sql("scored", "new_points", f"c{MODEL_ROUNDS}")}"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = episode_model(spark, sf_dir)
    normal = views.readings(spark, sf_dir).filter(~F.col("has_failure"))
    return sc.score(normal, model)


@query(
    f"""WITH {SCORED_SQL}
SELECT id AS reading_id, CAST(cluster_id AS INT) AS cluster_id FROM scored"""
)
def score_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("reading_id", "cluster_id")


_VERSIONS_SQL = ",\n".join(nearest_sql(f"by{v}", "new_points", f"c{v}") for v in range(1, MODEL_ROUNDS + 1))
_ALL_VERSIONS = " UNION ALL ".join(f"SELECT id, cluster_id, '{v}' AS model_version FROM by{v}" for v in range(1, MODEL_ROUNDS + 1))


@query(
    f"""WITH {SCORED_SQL},
{_VERSIONS_SQL},
every AS ({_ALL_VERSIONS}),
span AS (SELECT min(epoch_us("timestamp")) AS low, (max(epoch_us("timestamp")) - min(epoch_us("timestamp"))) // {MODEL_ROUNDS + 1} AS width FROM readings),
history AS (
  SELECT make_timestamp(low + v * width) AS since, CAST(v AS VARCHAR) AS model_version
  FROM span, range(1, {MODEL_ROUNDS + 1}) t(v)),
placed AS (
  SELECT r.reading_id, h.model_version FROM readings r ASOF LEFT JOIN history h ON r."timestamp" >= h.since
  WHERE NOT r.has_failure)
SELECT reading_id, model_version, CAST(cluster_id AS INT) AS cluster_id
FROM placed LEFT JOIN (SELECT id AS reading_id, cluster_id, model_version FROM every) USING (reading_id, model_version)"""
)
def score_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every normal reading scored by the model active at its time; a version is one more round of the fit."""
    vectors = tables.materialise(episode_vectors(spark, sf_dir), "as-of-vectors")
    mean, scale = cl.fit_scaler(vectors)
    points = cl.scale_vectors(vectors, mean, scale)
    readings = views.readings(spark, sf_dir)
    low, high = readings.agg(F.min("timestamp"), F.max("timestamp")).first()
    centroids, history = cl.first_points(points, MODEL_K), []
    for v in range(1, MODEL_ROUNDS + 1):
        centroids = cl.lloyd(points, centroids, 1)
        if low is not None:
            model = cl.Model(FEATURES, mean, scale, centroids, version=str(v))
            history.append((low + v * ((high - low) // (MODEL_ROUNDS + 1)), model))
    found = sc.score_as_of(readings.filter(~F.col("has_failure")), history)
    return found.select("reading_id", "model_version", "cluster_id")


# As many features as the default setup has: 20 sensors with 4 statistics and the duration.
WIDE = 81
_WIDE_ENTRY = "value * ((event_id * (pos + 1)) % 7 + 1) + pos * (event_id % 5)"


@query(
    f"""WITH w AS (SELECT event_id AS id, pos, {_WIDE_ENTRY} AS raw FROM events, range({WIDE}) t(pos)),
stats AS MATERIALIZED (
  SELECT pos, avg(raw) AS mean, CASE WHEN stddev_pop(raw) = 0 THEN 1.0 ELSE stddev_pop(raw) END AS scale
  FROM w GROUP BY pos),
points AS MATERIALIZED (SELECT id, pos, (raw - mean) / scale AS x FROM w JOIN stats USING (pos)),
first_three AS (SELECT DISTINCT id FROM points ORDER BY id LIMIT 3),
centres AS MATERIALIZED (
  SELECT rank() OVER (PARTITION BY pos ORDER BY id) - 1 AS cluster_id, pos, x AS v
  FROM points WHERE id IN (SELECT id FROM first_three)),
{nearest_sql("near", "points", "centres")}
SELECT id AS reading_id, CAST(cluster_id AS INT) AS cluster_id, round(d, 4) AS sq_distance FROM near"""
)
def score_wide_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaling and assignment at the width of the default sensor setup."""
    entries = [
        F.expr(_WIDE_ENTRY.replace("pos", str(i))).cast("double") for i in range(WIDE)
    ]
    vectors = views.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("failure_id"), F.array(*entries).alias("features")
    )
    mean, scale = cl.fit_scaler(vectors)
    centroids = cl.first_points(cl.scale_vectors(vectors, mean, scale), 3)
    near = cl.assign(vectors, centroids, mean=mean, scale=scale)
    return near.select(
        F.col("failure_id").alias("reading_id"), "cluster_id", F.round("sq_distance", 4).alias("sq_distance")
    )


@query(
    f"""WITH {SCORED_SQL}, {PAST_SQL}
SELECT s.id AS reading_id, CAST(s.cluster_id AS INT) AS cluster_id FROM scored s
WHERE NOT EXISTS (SELECT 1 FROM past p WHERE p.reading_id = s.id)"""
)
def score_unscored(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = episode_model(spark, sf_dir)
    found = sc.score_unscored(
        views.readings(spark, sf_dir), past_predictions(spark, sf_dir), model
    )
    return found.select("reading_id", "cluster_id")


@query(
    f"""WITH {READINGS_SQL}, {PAST_SQL}
SELECT reading_id, model_version FROM past"""
)
def prediction_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions merged from two overlapping tables."""
    past = past_predictions(spark, sf_dir)
    return sc.unique_predictions(past.unionAll(past.filter(F.col("model_version") == "2")))


@query(
    f"""WITH {SCORED_SQL}
SELECT id AS reading_id, CAST(cluster_id AS INT) AS cluster_id, '2' AS model_version,
       CAST(NULL AS DOUBLE) AS confidence_score, 'run-1' AS run_id,
       'sensor_failure_clustering' AS model_name
FROM scored"""
)
def prediction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of readings delivered twice: still one per reading and version."""
    model, _ = episode_model(spark, sf_dir)
    normal = views.readings(spark, sf_dir).filter(~F.col("has_failure"))
    twice = sc.score(normal.unionAll(normal), model)
    return sc.to_predictions(twice, model, as_of()).drop(
        "machine_id", "timestamp", "prediction_time"
    )


@query(
    f"""WITH {SCORED_SQL},
batches AS (SELECT reading_id, (row_number() OVER (ORDER BY "timestamp", reading_id) - 1) // 100 AS batch_no
             FROM readings WHERE NOT has_failure)
SELECT CAST(batch_no AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n_processed,
       CAST(count(DISTINCT cluster_id) AS BIGINT) AS n_clusters
FROM scored JOIN batches ON batches.reading_id = scored.id GROUP BY batch_no"""
)
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.batch_summary(sc.with_batch_no(scored(spark, sf_dir)))


@query(
    f"""WITH {SCORED_SQL}
SELECT s.id AS reading_id, CAST(s.cluster_id AS INT) AS cluster_id, CAST(m.size AS BIGINT) AS size,
       CASE WHEN m.size IS NULL THEN 'Cluster ' || CAST(s.cluster_id AS VARCHAR) || ' not found in profiles'
       END AS error
FROM scored s LEFT JOIN (SELECT DISTINCT cluster_id, size FROM means WHERE cluster_id <> 1) m
  ON m.cluster_id = s.cluster_id"""
)
def cluster_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prediction with its cluster's profile; cluster 1 is left without one."""
    model, assigned = episode_model(spark, sf_dir)
    normal = views.readings(spark, sf_dir).filter(~F.col("has_failure"))
    means = ds.profile_means(assigned.filter(F.col("cluster_id") != 1), FEATURES)
    return ds.describe_predictions(sc.score(normal, model), ds.cluster_profiles(means)).select(
        "reading_id", "cluster_id", "size", "error"
    )
