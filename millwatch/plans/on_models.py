"""Queries on clustering, cluster description and the model registry."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clustering as cl
from ..operators import describe as ds
from ..operators import profiles as pf
from ..operators import registry
from ..schemas import CLUSTERS, MODEL_CENTROIDS, MODEL_SCALER, PROFILE, RUNS, VERSIONS
from ..session import scratch_path
from ..sources import tables
from . import driver_views as views
from . import train as tr
from .catalog import query
from .on_ingest import AS_OF, as_of, episode_vectors, linked_failing, ntz, r6
from .sql_parts import (
    EPISODES_SQL,
    FEATURES,
    MODEL_K,
    MODEL_ROUNDS,
    MODEL_SQL,
    SCALED_SQL,
    SIMILARITY_SQL,
    lloyd_sql,
    nearest_sql,
    silhouette_sql,
)

DAYS = 30 * 24

EMBEDDING_SQL = """points AS MATERIALIZED (
  SELECT vec_id AS id, unnest(generate_series(0, len(embedding) - 1)) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
labeled AS (SELECT vec_id AS id, label AS cluster_id FROM embeddings)"""


def fixed_fit(points: DataFrame, k: int) -> list[list[float]]:
    """Lloyd from the first k points, so that another engine can repeat it."""
    return cl.lloyd(points, cl.first_points(points, k), MODEL_ROUNDS)


def training(
    spark: SparkSession, sf_dir: str, exact: bool = False, hours: int = DAYS, linked: DataFrame | None = None
) -> tr.Training:
    done = tr.train(
        linked_failing(spark, sf_dir) if linked is None else linked,
        as_of(),
        run_id="run-1",
        hours=hours,
        k=MODEL_K,
        patterns=pf.label_pattern(views.wide_readings(spark, sf_dir)),
        exact_silhouette=exact,
        fit=fixed_fit,
    )
    assert done is not None
    return done


def episode_model(spark: SparkSession, sf_dir: str) -> tuple[cl.Model, DataFrame]:
    """The fixed model of all episodes and the raw vectors with their clusters."""
    vectors = tables.materialise(episode_vectors(spark, sf_dir), "episode-vectors")
    mean, scale = cl.fit_scaler(vectors)
    centroids = fixed_fit(cl.scale_vectors(vectors, mean, scale), MODEL_K)
    model = cl.Model(FEATURES, mean, scale, centroids, run_id="run-1", version="2")
    assigned = cl.assign(vectors, centroids, "features", mean, scale)
    return model, assigned.drop("sq_distance")


def profile_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, assigned = episode_model(spark, sf_dir)
    return ds.profile_means(assigned, FEATURES)


def similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = pf.label_pattern(views.wide_readings(spark, sf_dir))
    return ds.label_similarity(profile_means(spark, sf_dir), patterns)


@query(
    f"""WITH {EMBEDDING_SQL},
centres AS MATERIALIZED (SELECT cluster_id, pos, avg(x) AS v FROM points JOIN labeled USING (id) GROUP BY ALL),
{nearest_sql("near", "points", "centres")}
SELECT id AS failure_id, CAST(cluster_id AS INT) AS cluster_id, round(d, 6) AS sq_distance FROM near"""
)
def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = views.vectors(spark, sf_dir)
    width = points.select(F.size("features")).first()[0]
    means = cl.bounded_rows(cl.cluster_means(points, width), 1000, "labels")
    centres = [list(r["means"]) for r in sorted(means, key=lambda r: r["cluster_id"])]
    return cl.assign(points, centres).select(
        "failure_id", "cluster_id", r6("sq_distance", "sq_distance")
    )


@query(
    f"""WITH {EMBEDDING_SQL},
{lloyd_sql(3, 3)}
SELECT CAST(cluster_id AS INT) AS cluster_id, CAST(pos AS INT) AS feature_pos, round(v, 6) AS value
FROM c3"""
)
def lloyd_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = views.vectors(spark, sf_dir)
    centroids = cl.lloyd(points, cl.first_points(points, 3), 3)
    rows = [(c, i, v) for c, centre in enumerate(centroids) for i, v in enumerate(centre)]
    return spark.createDataFrame(rows, "cluster_id int, feature_pos int, value double").select(
        "cluster_id", "feature_pos", r6("value", "value")
    )


@query(
    f"""WITH {SCALED_SQL}
SELECT count(DISTINCT id) AS n_points, 3::BIGINT AS n_clusters, 0::BIGINT AS n_misplaced,
       count(DISTINCT id) AS n_in_clusters, true AS better_than_one_cluster
FROM points"""
)
def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that hold for any start of Spark ML k-means on the scaled episodes.

    The centres are written as a table, and each point's assignment is checked by joining it with all of them.
    """
    vectors = tables.materialise(episode_vectors(spark, sf_dir), "episode-vectors")
    mean, scale = cl.fit_scaler(vectors)
    points = cl.scale_vectors(vectors, mean, scale)
    centroids = cl.fit_kmeans(points)
    model = cl.Model(FEATURES, mean, scale, centroids, run_id="run-k")
    cells, _ = cl.model_tables(spark, model)
    cells = tables.materialise(cells, "centroids").select(
        F.col("cluster_id").alias("candidate"), "feature_pos", F.col("value").alias("centre")
    )
    entries = points.select("failure_id", F.posexplode("features").alias("feature_pos", "x"))
    away = F.sum((F.col("x") - F.col("centre")) ** 2).alias("d")
    distances = entries.join(cells, "feature_pos").groupBy("failure_id", "candidate").agg(away)
    closest = distances.groupBy("failure_id").agg(F.min("d").alias("best"))
    assigned = cl.assign(points, centroids)
    sizes = cl.cluster_sizes(assigned, len(centroids)).agg(F.sum("size").alias("n_in_clusters"))
    wrong = F.coalesce(F.col("sq_distance") > F.col("best") * (1 + 1e-9) + 1e-9, F.lit(True))
    spread = F.sum(F.aggregate("features", F.lit(0.0), lambda s, x: s + x * x))
    return (
        assigned.join(closest, "failure_id")
        .agg(
            F.count(F.lit(1)).alias("n_points"),
            F.lit(len(centroids)).cast("bigint").alias("n_clusters"),
            F.count_if(wrong).alias("n_misplaced"),
            # the one-cluster solution of standardised points has its centre at 0
            (F.sum("sq_distance") < spread).alias("better_than_one_cluster"),
        )
        .join(sizes)
    )


@query(
    f"""WITH {EMBEDDING_SQL},
{silhouette_sql("sqrt(pairs.d)")}
SELECT round(silhouette, 6) AS silhouette FROM sil"""
)
def silhouette_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.silhouette_exact(views.vectors(spark, sf_dir), 10).select(
        r6("silhouette", "silhouette")
    )


@query(
    f"""WITH {EMBEDDING_SQL},
{silhouette_sql("pairs.d")}
SELECT round(silhouette, 6) AS silhouette FROM sil"""
)
def silhouette_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = cl.silhouette_fast(views.vectors(spark, sf_dir), 10)
    return spark.range(1).select(F.round(F.lit(value), 6).alias("silhouette"))


@query(
    """SELECT CAST(i AS INT) AS cluster_id, CAST(count(e.vec_id) AS BIGINT) AS size
FROM range(12) t(i) LEFT JOIN embeddings e ON e.label = i GROUP BY i"""
)
def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.cluster_sizes(views.vectors(spark, sf_dir), 12)


@query(
    f"""WITH {EPISODES_SQL}
SELECT CAST(k AS INT) AS k, (SELECT count(*) FROM failures) >= k AS enough
FROM (VALUES (3), (1000000)) t(k)"""
)
def min_data_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guard of the training job: with too few episodes there is no model."""
    rows = [
        (k, tr.train(linked_failing(spark, sf_dir), as_of(), "guard", hours=DAYS, k=k, fit=fixed_fit) is not None)
        for k in (3, 1_000_000)
    ]
    return spark.createDataFrame(rows, "k int, enough boolean")


@query(
    f"""WITH {MODEL_SQL}
SELECT CAST(cluster_id AS INT) AS cluster_id, CAST(size AS BIGINT) AS size,
       CAST(feature_pos AS INT) AS feature_pos, feature, round(value, 6) AS value FROM means"""
)
def cluster_profile_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_means(spark, sf_dir).select(
        "cluster_id", "size", "feature_pos", "feature", r6("value", "value")
    )


@query(
    f"""WITH {MODEL_SQL}
SELECT f.failure_id, CAST(l.cluster_id AS INT) AS cluster_id, f.value AS duration
FROM feats f JOIN labeled l ON l.id = f.failure_id
WHERE f.feature = 'duration' AND l.cluster_id <> 0"""
)
def cluster_labels_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes with the labels of a run that left cluster 0 unlabeled."""
    _, assigned = episode_model(spark, sf_dir)
    labels = assigned.filter(F.col("cluster_id") != 0)
    return ds.attach_clusters(assigned.drop("cluster_id"), labels).select(
        "failure_id", "cluster_id", F.element_at("features", -1).alias("duration")
    )


@query(
    f"""WITH {MODEL_SQL}
SELECT CAST(cluster_id AS INT) AS cluster_id, feature, round(value, 6) AS value, CAST(nth AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY abs(value) DESC, feature_pos) AS nth
      FROM means) WHERE nth <= 5"""
)
def distinctive_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ds.distinctive(profile_means(spark, sf_dir)).select(
        "cluster_id", "feature", r6("value", "value"), "rank"
    )


@query(
    f"""WITH {SIMILARITY_SQL}
SELECT CAST(cluster_id AS INT) AS cluster_id, CAST(label AS DOUBLE) AS label,
       round(similarity, 6) AS similarity FROM sims"""
)
def label_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarities(spark, sf_dir).select(
        "cluster_id", "label", r6("similarity", "similarity")
    )


@query(
    f"""WITH {SIMILARITY_SQL}
SELECT CAST(cluster_id AS INT) AS cluster_id,
       'label_' || CAST(CAST(arg_max(label, (similarity, -label)) AS DOUBLE) AS VARCHAR) AS most_similar_label,
       round(max(similarity), 6) AS similarity_score
FROM sims GROUP BY cluster_id"""
)
def best_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ds.best_label(similarities(spark, sf_dir)).select(
        "cluster_id", "most_similar_label", r6("similarity_score", "similarity_score")
    )


@query(
    f"""WITH {SIMILARITY_SQL},
best AS (SELECT cluster_id, arg_max(label, (similarity, -label)) AS label FROM sims GROUP BY cluster_id),
top AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY abs(value) DESC, feature_pos) AS nth
        FROM means)
SELECT 'cluster_' || CAST(cluster_id AS VARCHAR) AS cluster_name, CAST(size AS BIGINT) AS size,
       top.feature, round(value, 6) AS value, nth <= 5 AS distinctive,
       'label_' || CAST(CAST(label AS DOUBLE) AS VARCHAR) AS most_similar_label
FROM top JOIN best USING (cluster_id)"""
)
def profile_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profiles written as JSON and read back."""
    patterns = pf.label_pattern(views.wide_readings(spark, sf_dir))
    means = tables.materialise(profile_means(spark, sf_dir), "profile-means")
    best = ds.best_label(ds.label_similarity(means, patterns))
    path = scratch_path(spark, "profiles-json")
    tables.write_json(ds.profiles_json(ds.cluster_profiles(means, best)), path)
    profile_map = T.MapType(T.StringType(), PROFILE)
    text = spark.read.schema("json string").json(path)
    profiles = text.select(F.explode(F.from_json("json", profile_map)).alias("cluster_name", "p"))
    top = F.transform("p.distinctive_features", lambda e: e["feature"])
    return profiles.select(
        "cluster_name", "p", F.explode("p.all_features").alias("feature", "value")
    ).select(
        "cluster_name",
        F.col("p.size").alias("size"),
        "feature",
        r6("value", "value"),
        F.array_contains(top, F.col("feature")).alias("distinctive"),
        F.col("p.label_comparison.most_similar_label").alias("most_similar_label"),
    )


# A lookback that leaves the older episodes out.
RECENT_HOURS = 16 * 24
RECENT_SQL = MODEL_SQL.replace(
    "FROM members GROUP BY",
    f"FROM members WHERE start_time >= TIMESTAMP '{AS_OF}' - INTERVAL {RECENT_HOURS} HOUR "
    f"AND start_time < TIMESTAMP '{AS_OF}' GROUP BY",
)
_SECOND = ("pairs", "towards", "ab", "sil")


def _silhouettes_sql() -> str:
    """``sil`` and ``sil2``: the Euclidean and the squared-Euclidean mean."""
    squared = silhouette_sql("pairs.d")
    for name in _SECOND:
        squared = re.sub(rf"\b{name}\b", f"{name}2", squared)
    return silhouette_sql("sqrt(pairs.d)") + ",\n" + squared


@query(
    f"""WITH {RECENT_SQL},
{_silhouettes_sql()},
both_metrics AS (SELECT silhouette, '{tr.EXACT_METRIC}' AS metric FROM sil
                 UNION ALL SELECT silhouette, '{tr.FAST_METRIC}' FROM sil2)
SELECT 'run-1' AS run_id, 'failure_analysis_' || strftime(TIMESTAMP '{AS_OF}', '%Y%m%d_%H%M') AS run_name,
       {MODEL_K} AS n_clusters, (SELECT CAST(count(*) AS BIGINT) FROM labeled) AS n_failures,
       {RECENT_HOURS} AS training_lookback_hours, round(silhouette, 6) AS silhouette_score,
       metric AS silhouette_metric
FROM both_metrics"""
)
def run_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training job with either metric; the run records appended to a table and read back."""
    path = scratch_path(spark, "runs")
    # linked once, as the service stores it
    linked = tables.materialise(linked_failing(spark, sf_dir), "linked")
    for exact in (False, True):
        tables.append(training(spark, sf_dir, exact, RECENT_HOURS, linked).run, path, RUNS)
    return tables.read(spark, path, RUNS).withColumn(
        "silhouette_score", F.round("silhouette_score", 6)
    )


@query(
    f"""WITH {MODEL_SQL}
SELECT CAST(c.cluster_id AS INT) AS cluster_id, CAST(c.pos AS INT) AS feature_pos, f.feature,
       round(c.v, 6) AS value, round(s.mean, 6) AS mean, round(s.scale, 6) AS scale
FROM c{MODEL_ROUNDS} c JOIN scaler s ON s.feature_pos = c.pos
JOIN (SELECT DISTINCT feature_pos, feature FROM feats) f ON f.feature_pos = c.pos"""
)
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model written to its tables, loaded and taken apart again."""
    model, _ = episode_model(spark, sf_dir)
    root = scratch_path(spark, "model")
    centroids, scaler = cl.model_tables(spark, model)
    tables.append(centroids, f"{root}/model_centroids", MODEL_CENTROIDS)
    tables.append(scaler, f"{root}/model_scaler", MODEL_SCALER)
    loaded = cl.load_model(
        tables.read(spark, f"{root}/model_centroids", MODEL_CENTROIDS),
        tables.read(spark, f"{root}/model_scaler", MODEL_SCALER),
        "run-1",
    )
    centroids, scaler = cl.model_tables(spark, loaded)
    return centroids.join(scaler.drop("run_id", "feature"), "feature_pos").select(
        "cluster_id",
        "feature_pos",
        "feature",
        r6("value", "value"),
        r6("mean", "mean"),
        r6("scale", "scale"),
    )


@query(
    f"""WITH {MODEL_SQL}
SELECT 'run-1' AS run_id, 1 AS model_version, true AS is_active, {MODEL_K} AS n_clusters,
       'cluster_' || CAST(cluster_id AS VARCHAR) AS cluster_name, CAST(any_value(size) AS BIGINT) AS size,
       'run-1' AS signalled_run, false AS is_processed
FROM means GROUP BY cluster_id"""
)
def registry_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training run published to an empty registry: model row, profiles and version signal."""
    root = scratch_path(spark, "registry")
    tr.publish(spark, root, training(spark, sf_dir), as_of())
    signal = tables.read(spark, f"{root}/versions", VERSIONS).select(
        F.col("id"), F.col("run_id").alias("signalled_run"), "is_processed"
    )
    return (
        tables.read(spark, f"{root}/clusters", CLUSTERS)
        .join(signal, "id")
        .select(
            "run_id",
            "model_version",
            "is_active",
            "n_clusters",
            F.explode("cluster_profiles").alias("cluster_name", "profile"),
            "signalled_run",
            "is_processed",
        )
        .withColumn("size", F.col("profile.size"))
        .drop("profile")
    )


def daily_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with one model per day of events; two in three days left several active."""
    day = F.to_date("ts").alias("day")
    days = (
        views.table(spark, sf_dir, "events")
        .groupBy(day)
        .agg(
            F.max("ts").alias("created_at"),
            F.count_distinct("event_type").alias("n_clusters"),
            F.avg("value").alias("score"),
        )
    )
    # one row per day of events
    order = Window.orderBy("day")
    return days.select(
        F.row_number().over(order).cast("bigint").alias("id"),
        F.concat(F.lit("run-"), F.col("day").cast("string")).alias("run_id"),
        F.row_number().over(order).alias("model_version"),
        F.col("created_at").cast("timestamp").alias("created_at"),
        (F.dayofmonth("day") % 3 != 0).alias("is_active"),
        F.col("n_clusters").cast("int").alias("n_clusters"),
    )


DAILY_SQL = """models AS (
  SELECT row_number() OVER (ORDER BY day) AS id, 'run-' || CAST(day AS VARCHAR) AS run_id,
         CAST(row_number() OVER (ORDER BY day) AS INT) AS model_version, created_at,
         extract(day FROM day) % 3 <> 0 AS is_active, n_clusters
  FROM (SELECT CAST(ts AS DATE) AS day, max(ts) AS created_at,
               CAST(count(DISTINCT event_type) AS INT) AS n_clusters
        FROM events GROUP BY 1))"""


@query(
    f"""WITH {DAILY_SQL}
SELECT * FROM models WHERE is_active ORDER BY id DESC LIMIT 1"""
)
def active_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.active_model(daily_models(spark, sf_dir)).withColumn(
        "created_at", ntz("created_at")
    )


@query(
    f"""WITH {DAILY_SQL}
SELECT id, run_id, created_at, id = (SELECT max(id) FROM models) AS is_active FROM models"""
)
def model_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    switched = registry.switch_model(daily_models(spark, sf_dir))
    return switched.select("id", "run_id", ntz("created_at"), "is_active")


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_models(spark, sf_dir).select(
        "id",
        F.col("model_version").cast("string").alias("version"),
        "run_id",
        "created_at",
        (~F.col("is_active")).alias("is_processed"),
    )


@query(
    f"""WITH {DAILY_SQL}
SELECT id, CAST(model_version AS VARCHAR) AS version, run_id, created_at
FROM models WHERE is_active ORDER BY created_at DESC LIMIT 1"""
)
def pending_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = registry.pending_version(_signals(spark, sf_dir))
    return newest.select("id", "version", "run_id", ntz("created_at"))


@query(
    f"""WITH {DAILY_SQL}
SELECT id, NOT is_active OR id = (SELECT max(id) FROM models WHERE is_active) AS is_processed
FROM models"""
)
def version_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.mark_processed(_signals(spark, sf_dir)).select("id", "is_processed")
