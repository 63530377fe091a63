"""Scoring of normal readings against a model."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import MODEL_NAME, SCORING_BATCH_SIZE
from ..functions.scale import ROWS_PER_CELL, with_global_rank
from ..functions.sensors import single_reading_features
from .clustering import Model, assign, nearest, scaled

MAX_HISTORY = 64


def unscored(
    readings: DataFrame, predictions: DataFrame, rescore_version: str | None = None
) -> DataFrame:
    """Normal readings with values that no model version has scored.

    With ``rescore_version`` only predictions of that version count as scored. Readings without
    values can never be scored and are left out.
    """
    done = _counted(predictions, rescore_version)
    return scorable(readings).join(done.select("reading_id"), "reading_id", "left_anti")


def scorable(readings: DataFrame) -> DataFrame:
    """Normal readings with values."""
    return readings.filter(~F.col("has_failure") & (F.size("values") > 0))


def score_unscored(
    readings: DataFrame,
    predictions: DataFrame,
    model: Model,
    rescore_version: str | None = None,
) -> DataFrame:
    """Scores the unscored readings: ``(reading_id, machine_id, timestamp, cluster_id)``.

    Scores first and then drops what was scored before, because a cluster id is far cheaper to
    shuffle than a value map. An outer join does that: the optimizer would move an anti join
    back below the scoring.
    """
    # one row per reading, however many versions have scored it
    done = _counted(predictions, rescore_version).select(F.col("reading_id").alias("_done")).distinct()
    scored = score(scorable(readings), model).select(
        "reading_id", "machine_id", "timestamp", "cluster_id"
    )
    return (
        scored.join(done, F.col("reading_id") == F.col("_done"), "left")
        .filter(F.col("_done").isNull())
        .drop("_done")
    )


def _counted(predictions: DataFrame, version: str | None) -> DataFrame:
    return predictions if version is None else predictions.filter(F.col("model_version") == version)


def oldest(readings: DataFrame, n: int = SCORING_BATCH_SIZE) -> DataFrame:
    """The n oldest readings, as a top-n without a full sort."""
    return readings.orderBy("timestamp", "reading_id").limit(n)


def with_batch_no(
    readings: DataFrame, size: int = SCORING_BATCH_SIZE, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Numbers the oldest-first batches of ``size`` readings, from 0."""
    ranked = with_global_rank(readings, rows_per_cell=rows_per_cell)
    return ranked.withColumn("batch_no", F.floor(F.col("rank") / size).cast("bigint")).drop("rank")


def reading_vector(model_features: list[str], values: str = "values") -> Column:
    return F.array(*single_reading_features(model_features, F.col(values)))


def score(readings: DataFrame, model: Model) -> DataFrame:
    """Adds ``cluster_id`` in one pass over the readings, without join or shuffle."""
    vectors = readings.withColumn("_x", reading_vector(model.features))
    return assign(vectors, model.centroids, "_x", model.mean, model.scale).drop(
        "_x", "sq_distance"
    )


def score_as_of(
    readings: DataFrame, history: Sequence[tuple[datetime, Model]], max_history: int = MAX_HISTORY
) -> DataFrame:
    """Adds ``cluster_id`` and ``model_version`` of the model that was active at each reading's time.

    A model is active from its time, that instant included, to the time of the next; of two with one time the later
    in ``history`` counts. Both columns are NULL before the first model, and with a NULL time; a reading
    without a usable vector has a version and no cluster. One pass without join or shuffle, so no
    time range is hot: models are constants of the plan, ``max_history`` of them at most, and each row computes only its own.
    """
    if len(history) > max_history:
        raise ValueError(f"{len(history)} models in the history, {max_history} at most")
    ordered = sorted(history, key=lambda entry: entry[0])
    kept = readings.columns
    version, cluster = F.lit(None).cast("string"), F.lit(None).cast("int")
    rows = readings
    for i, (start, model) in enumerate(ordered):
        active = F.col("timestamp") >= F.lit(start)
        if i + 1 < len(ordered):
            active &= F.col("timestamp") < F.lit(ordered[i + 1][0])
        rows = rows.withColumn(f"_x{i}", F.when(active, reading_vector(model.features)))
        rows = rows.withColumn(f"_s{i}", scaled(f"_x{i}", model.mean, model.scale))
        rows = rows.withColumn(f"_near{i}", nearest(f"_s{i}", model.centroids))
        cluster = F.when(active, F.col(f"_near{i}.cluster_id")).otherwise(cluster)
        version = F.when(active, F.lit(model.version)).otherwise(version)
    return rows.select(*kept, cluster.alias("cluster_id"), version.alias("model_version"))


def to_predictions(scored: DataFrame, model: Model, at: Column) -> DataFrame:
    """Prediction rows of one model, one per reading and thereby per reading and version."""
    return scored.dropDuplicates(["reading_id"]).select(
        "reading_id",
        "machine_id",
        "timestamp",
        "cluster_id",
        F.lit(model.version).alias("model_version"),
        F.lit(None).cast("double").alias("confidence_score"),
        at.alias("prediction_time"),
        F.lit(model.run_id).alias("run_id"),
        F.lit(MODEL_NAME).alias("model_name"),
    )


def unique_predictions(predictions: DataFrame) -> DataFrame:
    """One prediction per reading and model version, as when tables are merged."""
    return predictions.dropDuplicates(["reading_id", "model_version"])


def batch_summary(scored: DataFrame) -> DataFrame:
    """Readings and distinct clusters per batch."""
    return scored.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_processed"), F.count_distinct("cluster_id").alias("n_clusters")
    )
