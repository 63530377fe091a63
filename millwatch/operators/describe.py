"""Cluster profiles and their comparison with labeled patterns; all results are model-sized."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import TOP_FEATURES
from .clustering import cluster_means


def cluster_name(cluster_id: Column) -> Column:
    return F.concat(F.lit("cluster_"), cluster_id.cast("string"))


def label_name(label: Column) -> Column:
    return F.concat(F.lit("label_"), label.cast("double").cast("string"))


def run_name(at: Column) -> Column:
    return F.concat(F.lit("failure_analysis_"), F.date_format(at, "yyyyMMdd_HHmm"))


def attach_clusters(vectors: DataFrame, labels: DataFrame) -> DataFrame:
    """Vectors with the cluster of their episode; episodes without a cluster drop out."""
    known = labels.select("failure_id", "cluster_id")
    return (
        vectors.join(known, "failure_id", "left")
        .withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1)))
        .filter(F.col("cluster_id") != -1)
    )


def profile_means(assigned: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean of every raw feature per cluster: ``(cluster_id, size, feature_pos, feature, value)``."""
    labels = F.array(*[F.lit(n) for n in names])
    return (
        cluster_means(assigned, len(names))
        .select("cluster_id", "size", F.posexplode("means").alias("feature_pos", "value"))
        .withColumn("feature", F.element_at(labels, F.col("feature_pos") + 1))
    )


def distinctive(means: DataFrame, top: int = TOP_FEATURES) -> DataFrame:
    """The features with the largest absolute mean per cluster; ties keep feature order."""
    order = Window.partitionBy("cluster_id").orderBy(F.abs("value").desc(), "feature_pos")
    return means.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def label_similarity(means: DataFrame, patterns: DataFrame) -> DataFrame:
    """Similarity of every cluster to every label over the sensors they share.

    A sensor scores ``1 / (1 + |difference of means| / std)``; sensors without spread are left
    out and a pair without any sensor has no row.
    """
    spread = F.col("std")
    away = F.abs(F.col("value") - F.col("mean")) / spread
    return (
        patterns.filter(spread > 0)
        .withColumn("feature", F.concat("sensor", F.lit("_mean")))
        .join(means.select("cluster_id", "feature", "value"), "feature")
        .groupBy("cluster_id", "label")
        .agg(F.avg(1 / (1 + away)).alias("similarity"))
    )


def best_label(similarities: DataFrame) -> DataFrame:
    """The most similar label per cluster, the lowest of equals, with all similarities."""
    score = F.col("similarity")
    return similarities.groupBy("cluster_id").agg(
        F.max_by(label_name(F.col("label")), F.struct(score, -F.col("label"))).alias(
            "most_similar_label"
        ),
        F.max(score).alias("similarity_score"),
        F.map_from_entries(F.collect_list(F.struct(label_name(F.col("label")), score))).alias(
            "all_similarities"
        ),
    )


def cluster_profiles(means: DataFrame, best: DataFrame | None = None) -> DataFrame:
    """One row per cluster with size, top features, all features and, if known, its label."""
    ranked = Window.partitionBy("cluster_id").orderBy(F.abs("value").desc(), "feature_pos")
    entry = F.struct("feature", "value")
    in_rank = F.array_sort(
        F.collect_list(F.when(F.col("_rank") <= TOP_FEATURES, F.struct("_rank", "feature", "value")))
    )
    profiles = (
        means.withColumn("_rank", F.row_number().over(ranked))
        .groupBy("cluster_id", "size")
        .agg(
            F.transform(in_rank, lambda e: F.struct(e["feature"], e["value"])).alias(
                "distinctive_features"
            ),
            F.map_from_entries(F.collect_list(entry)).alias("all_features"),
        )
        .withColumn("cluster_name", cluster_name(F.col("cluster_id")))
    )
    fields = ("most_similar_label", "similarity_score", "all_similarities")
    if best is None:
        return profiles.withColumn("label_comparison", F.lit(None))
    return profiles.join(best, "cluster_id", "left").select(
        *profiles.columns,
        F.when(F.col("most_similar_label").isNotNull(), F.struct(*fields)).alias("label_comparison"),
    )


def profiles_json(profiles: DataFrame) -> DataFrame:
    """All profiles as one JSON object keyed by cluster name."""
    body = F.struct("size", "distinctive_features", "all_features", "label_comparison")
    entries = F.collect_list(F.struct(F.col("cluster_name"), body.alias("profile")))
    by_name = F.map_from_entries(
        F.array_sort(
            entries,
            lambda a, b: F.when(a["cluster_name"] < b["cluster_name"], -1).otherwise(1),
        )
    )
    return profiles.agg(F.to_json(by_name).alias("json"))


def describe_predictions(predictions: DataFrame, profiles: DataFrame) -> DataFrame:
    """Predictions with their cluster's profile, or the reason why there is none.

    ``profiles`` has one row per cluster of one model; how it is joined is left to its size.
    """
    known = profiles.drop("cluster_name")
    n_profiles = profiles.agg(F.count(F.lit(1))).scalar()
    missing = F.concat(
        F.lit("Cluster "), F.col("cluster_id").cast("string"), F.lit(" not found in profiles")
    )
    error = F.when(n_profiles == 0, "No cluster profiles loaded").when(
        F.col("size").isNull(), missing
    )
    return predictions.join(known, "cluster_id", "left").withColumn("error", error)
