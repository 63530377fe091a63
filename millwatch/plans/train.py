"""The training job: linked readings to a described, published model."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.fixed import LOOKBACK_HOURS, N_CLUSTERS
from ..functions.sensors import feature_names
from ..operators import clustering as cl
from ..operators import describe as ds
from ..operators import registry
from ..operators.episodes import in_lookback
from ..operators.features import episode_stats, episode_vectors, stats_sensors
from ..operators.scoring import MAX_HISTORY
from ..schemas import CLUSTERS, MODEL_CENTROIDS, MODEL_SCALER, PICKUPS, RUNS, VERSIONS
from ..sources import tables
from ..sources.commits import Commits, Taken


EXACT_METRIC, FAST_METRIC = "euclidean", "squared_euclidean"


@dataclass(frozen=True)
class Training:
    """A trained model, the assigned raw vectors, the cluster profiles and the run record."""

    model: cl.Model
    assigned: DataFrame
    profiles: DataFrame
    run: DataFrame


def train(
    linked: DataFrame,
    as_of: Column,
    run_id: str,
    version: str = "1",
    hours: int = LOOKBACK_HOURS,
    k: int = N_CLUSTERS,
    patterns: DataFrame | None = None,
    exact_silhouette: bool = False,
    fit: Callable[[DataFrame, int], list[list[float]]] = cl.fit_kmeans,
) -> Training | None:
    """Trains on the episodes that started in the lookback; None with fewer than k of them.

    The filter on ``failure_start`` replaces a join with the failures, and on a stored table the
    matching filter on the reading time limits the scan to the days of the lookback. The
    silhouette is the linear, squared-Euclidean one; the Euclidean one compares all pairs of episodes
    and is computed on request. The run record names which it is.
    """
    since = as_of - F.make_dt_interval(hours=F.lit(hours))
    members = linked.filter(F.col("failure_id").isNotNull() & (F.col("timestamp") >= since))
    stats = tables.materialise(
        episode_stats(in_lookback(members, as_of, hours, "failure_start")), "episode-stats"
    )
    sensors = stats_sensors(stats)
    names = feature_names(sensors)
    vectors = tables.materialise(episode_vectors(stats, sensors), "episode-vectors")
    n_failures = trainable(vectors, k)
    if n_failures is None:
        return None

    mean, scale = cl.fit_scaler(vectors)
    points = cl.scale_vectors(vectors, mean, scale)
    centroids = fit(points, k)
    model = cl.Model(names, mean, scale, centroids, run_id=run_id, version=version)
    assigned = cl.assign(
        vectors.withColumn("_x", cl.scaled("features", mean, scale)), centroids, "_x"
    )
    labeled = assigned.select("failure_id", "cluster_id", F.col("_x").alias("features"))
    if exact_silhouette:
        quality = cl.silhouette_exact(labeled, k).first()[0]
    else:
        quality = cl.silhouette_fast(labeled, k)
    model = replace(model, silhouette=float(quality))
    assigned = assigned.drop("_x", "sq_distance")

    means = ds.profile_means(assigned, names)
    best = None if patterns is None else ds.best_label(ds.label_similarity(means, patterns))
    profiles = ds.cluster_profiles(means, best)
    metric = EXACT_METRIC if exact_silhouette else FAST_METRIC
    run = run_record(linked.sparkSession, model, k, n_failures, hours, as_of, metric)
    return Training(model, assigned, profiles, run)


def trainable(vectors: DataFrame, k: int) -> int | None:
    """The number of episodes, or None if they are too few for k clusters."""
    n = vectors.count()
    return n if n and n >= k else None


def run_record(
    spark: SparkSession,
    model: cl.Model,
    k: int,
    n_failures: int,
    hours: int,
    as_of: Column,
    metric: str = FAST_METRIC,
) -> DataFrame:
    """Parameters and metrics of one run."""
    return spark.range(1).select(
        F.lit(model.run_id).alias("run_id"),
        ds.run_name(as_of).alias("run_name"),
        F.lit(k).cast("int").alias("n_clusters"),
        F.lit(n_failures).cast("bigint").alias("n_failures"),
        F.lit(hours).cast("int").alias("training_lookback_hours"),
        F.lit(model.silhouette).alias("silhouette_score"),
        F.lit(metric).alias("silhouette_metric"),
    )


def profile_map(profiles: DataFrame) -> DataFrame:
    """All profiles in one row as a map from cluster name to profile."""
    body = F.struct("size", "distinctive_features", "all_features", "label_comparison")
    return profiles.agg(
        F.map_from_entries(F.collect_list(F.struct("cluster_name", body))).alias("cluster_profiles")
    )


def publish(spark: SparkSession, root: str, done: Training, created_at: Column) -> None:
    """Appends the model to the registry below ``root`` and signals the new version.

    The model tables come first and the signal last, so whoever sees the signal finds the model.
    Readers derive which row is active (:func:`registry.switch_model`). Several writers may publish at once:
    each claims an id of its own with a commit file, and the highest one is active.
    """
    model = done.model
    number = claim_id(spark, root, model.run_id)
    centroids, scaler = cl.model_tables(spark, model)
    tables.append(centroids, f"{root}/model_centroids", MODEL_CENTROIDS)
    tables.append(scaler, f"{root}/model_scaler", MODEL_SCALER)
    tables.append(done.run, f"{root}/runs", RUNS)
    row = profile_map(done.profiles).select(
        F.lit(number).cast("bigint").alias("id"),
        F.lit(model.run_id).alias("run_id"),
        F.lit(model.version).cast("int").alias("model_version"),
        created_at.alias("created_at"),
        F.lit(True).alias("is_active"),
        F.lit(len(model.centroids)).alias("n_clusters"),
        F.lit(model.silhouette).alias("silhouette_score"),
        "cluster_profiles",
    )
    tables.append(row, f"{root}/clusters", CLUSTERS)
    signal = spark.range(1).select(
        F.lit(number).cast("bigint").alias("id"),
        F.lit(model.version).alias("version"),
        F.lit(model.run_id).alias("run_id"),
        created_at.alias("created_at"),
        F.lit(False).alias("is_processed"),
    )
    tables.append(signal, f"{root}/versions", VERSIONS)


def claim_id(spark: SparkSession, root: str, run_id: str) -> int:
    """An id above all that the registry knows, taken by one writer only; a lost race tries the next."""
    commits = Commits(spark, f"{root}/registry")
    number = commits.next_free()
    if not number:  # a registry older than its commits
        number = registry.next_id(tables.read(spark, f"{root}/clusters", CLUSTERS)) - 1
    while True:
        try:
            commits.create(number, {"run_id": run_id})
            return number + 1
        except Taken:
            number = max(number + 1, commits.next_free())


def load_active(spark: SparkSession, root: str) -> cl.Model | None:
    """The active model of the registry below ``root``."""
    clusters = registry.switch_model(tables.read(spark, f"{root}/clusters", CLUSTERS))
    row = registry.active_model(clusters).select("run_id", "model_version").first()
    if row is None:
        return None
    return cl.load_model(
        tables.read(spark, f"{root}/model_centroids", MODEL_CENTROIDS),
        tables.read(spark, f"{root}/model_scaler", MODEL_SCALER),
        row["run_id"],
        str(row["model_version"]),
    )


def load_history(
    spark: SparkSession, root: str, limit: int = MAX_HISTORY
) -> list[tuple[datetime, cl.Model]]:
    """The models of the registry with the times from which they were active, the last ``limit`` of them.

    A model that was published when one with a higher id was there already was never active.
    """
    clusters = tables.read(spark, f"{root}/clusters", CLUSTERS)
    newest = F.max("id").over(Window.orderBy("created_at", "id"))
    rows = (
        clusters.select("id", "run_id", "model_version", "created_at")
        .withColumn("_newest", newest)
        .filter(F.col("id") == F.col("_newest"))
        .orderBy(F.col("id").desc())
        .limit(limit)
        .collect()
    )
    centroids = tables.read(spark, f"{root}/model_centroids", MODEL_CENTROIDS)
    scaler = tables.read(spark, f"{root}/model_scaler", MODEL_SCALER)
    return [
        (r["created_at"], cl.load_model(centroids, scaler, r["run_id"], str(r["model_version"])))
        for r in reversed(rows)
    ]


def current_versions(spark: SparkSession, root: str) -> DataFrame:
    """The version signals, processed once they were picked up."""
    picked = tables.read(spark, f"{root}/pickups", PICKUPS).select("id").distinct()
    return (
        tables.read(spark, f"{root}/versions", VERSIONS)
        .join(picked.withColumn("_picked", F.lit(True)), "id", "left")
        .withColumn("is_processed", F.col("is_processed") | F.coalesce("_picked", F.lit(False)))
        .drop("_picked")
    )


def pick_up_versions(spark: SparkSession, root: str) -> bool:
    """Takes note of all pending signals; whether there were any."""
    pending = current_versions(spark, root).filter(~F.col("is_processed")).select("id")
    if pending.isEmpty():
        return False
    noted = pending.withColumn("picked_up_at", F.current_timestamp())
    tables.append(noted, f"{root}/pickups", PICKUPS)
    return True
