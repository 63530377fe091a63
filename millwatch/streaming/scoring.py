"""Continuous scoring of linked readings, with drift kept in tables across restarts."""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.fixed import DRIFT_THRESHOLD, DRIFT_WINDOW, SCORING_BATCH_SIZE
from ..operators import drift as dr
from ..operators import scoring as sc
from ..operators.clustering import Model
from ..plans.train import load_active, pick_up_versions
from ..schemas import DISTRIBUTIONS, DRIFT, PREDICTIONS
from ..sources import tables

LOG = logging.getLogger(__name__)

# Predictions that one task numbers.
ROWS_PER_BATCH_CELL = 125_000


def start_scoring(
    readings: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    batch_size: int = SCORING_BATCH_SIZE,
    window: int = DRIFT_WINDOW,
    threshold: float = DRIFT_THRESHOLD,
    reset_on_model_change: bool = False,
    poll_seconds: float = 5.0,
    wait_seconds: float | None = None,
) -> StreamingQuery:
    """Scores a stream of linked readings with the model active at each trigger.

    The usual trigger is ``{"processingTime": "30 seconds"}``. While the registry is empty the
    first micro-batch waits, looking every ``poll_seconds``, and fails after ``wait_seconds`` if that is set. The
    model is loaded again when a new version has been signalled.
    """
    loaded: list[Model] = []

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if pick_up_versions(spark, root) or not loaded:
            began = time.monotonic()
            while (model := load_active(spark, root)) is None:
                if wait_seconds is not None and time.monotonic() - began >= wait_seconds:
                    raise TimeoutError(f"no active model below {root} after {wait_seconds} seconds")
                LOG.warning("no active model below %s, looking again in %s seconds", root, poll_seconds)
                time.sleep(poll_seconds)
            loaded[:] = [model]
        score_batch(
            batch, batch_id, root, loaded[0], batch_size, window, threshold, reset_on_model_change
        )

    return (
        readings.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def score_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    model: Model,
    batch_size: int = SCORING_BATCH_SIZE,
    window: int = DRIFT_WINDOW,
    threshold: float = DRIFT_THRESHOLD,
    reset_on_model_change: bool = False,
) -> None:
    """Scores the new readings of a micro-batch and extends distributions and drift events."""
    spark = batch.sparkSession
    # only the days of this batch can hold earlier predictions of its readings
    days = tables.days_of(batch)
    earlier = tables.read_days(spark, f"{root}/predictions", PREDICTIONS, days).filter(
        F.col("batch_id") < batch_id
    )
    scored = sc.score_unscored(batch, earlier, model)
    rows = sc.to_predictions(scored, model, F.current_timestamp())
    tables.write_batch(rows, f"{root}/predictions", batch_id, PREDICTIONS, by_date="timestamp")
    stored = tables.read_days(spark, f"{root}/predictions", PREDICTIONS, days, batch_id)
    k = len(model.centroids)
    only = model.run_id if reset_on_model_change else None
    update_drift(stored, batch_id, root, k, batch_size, window, threshold, model.run_id, only)


def update_drift(
    predictions: DataFrame,
    batch_id: int,
    root: str,
    k: int,
    batch_size: int = SCORING_BATCH_SIZE,
    window: int = DRIFT_WINDOW,
    threshold: float = DRIFT_THRESHOLD,
    run_id: str = "",
    only_run: str | None = None,
) -> None:
    """Adds the distributions of new predictions and the drift events they cause.

    The state read back holds the first window of batches, which is the reference, and the last
    one: two windows of rows however long the stream has run. With ``only_run`` batches of other
    models are forgotten, so that each model gets its own numbering and reference.
    """
    spark = predictions.sparkSession
    state = spark.createDataFrame([], DISTRIBUTIONS)
    if batch_id > 0:  # a lost state is an error, not a new reference
        state = spark.read.schema(DISTRIBUTIONS).parquet(tables.slot(f"{root}/drift_state", batch_id - 1))
    if only_run is not None:
        state = state.filter(F.col("run_id") == only_run)
    last, width = state.agg(F.max("batch_no"), F.max(F.size("freqs"))).first()
    first_new = 0 if last is None else last + 1
    k = max(k, width or 0)
    numbered = sc.with_batch_no(predictions, batch_size, ROWS_PER_BATCH_CELL).withColumn(
        "batch_no", F.col("batch_no") + first_new
    )
    path = f"{root}/distributions"
    shares = dr.batch_distribution(numbered, k).withColumn("run_id", F.lit(run_id))
    tables.write_batch(shares, path, batch_id, DISTRIBUTIONS)
    fresh = tables.read_batch(spark, path, DISTRIBUTIONS, batch_id)
    known = state.unionByName(tables.conform(fresh, DISTRIBUTIONS))
    reference = dr.reference_distribution(known, k, window)
    recent = known.filter(F.col("batch_no") > first_new - window)
    series = dr.drift_series(recent, k, window, threshold, reference)
    events = dr.drift_events(series.filter(F.col("batch_no") >= first_new), F.current_timestamp())
    tables.write_batch(
        events.withColumn("run_id", F.lit(run_id)), f"{root}/drift", batch_id, DRIFT
    )
    newest = known.agg(F.max("batch_no")).scalar()
    kept = known.filter((F.col("batch_no") < window) | (F.col("batch_no") > newest - window))
    kept.coalesce(1).write.mode("overwrite").parquet(tables.slot(f"{root}/drift_state", batch_id))
