"""Drift of the predicted-cluster distribution over a sliding window of batches.

A batch's distribution is an array of frequencies indexed by cluster id, so no batch-by-cluster
grid is built and alignment is positional.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import DRIFT_THRESHOLD, DRIFT_WINDOW

# Batches per task of the sliding window.
BATCHES_PER_CELL = 500_000


def batch_distribution(scored: DataFrame, k: int) -> DataFrame:
    """``(batch_no, n, freqs)``: share of each cluster 0..k-1 in every batch.

    Readings without a cluster do not count. A cluster from ``k`` on fails the job, as the shares
    would no longer add up to 1.
    """
    total = F.count(F.lit(1))
    beyond = F.concat(F.lit(f"cluster beyond the {k} of the model: "), F.col("cluster_id").cast("string"))
    known = F.when(F.col("cluster_id").between(0, k - 1), F.col("cluster_id")).otherwise(
        F.raise_error(beyond)
    )
    rows = scored.filter("cluster_id is not null").select("batch_no", known.alias("_cluster"))
    freqs = F.array(*[F.count_if(F.col("_cluster") == c) / total for c in range(k)])
    return rows.groupBy("batch_no").agg(total.alias("n"), freqs.alias("freqs"))


def distribution_long(distributions: DataFrame, column: str = "freqs") -> DataFrame:
    """One row per batch and cluster that occurs in it."""
    keys = [c for c in ("batch_no", "n") if c in distributions.columns]
    return distributions.select(
        *keys, F.posexplode(column).alias("cluster_id", "freq")
    ).filter(F.col("freq") > 0)


def as_map(freqs: Column) -> Column:
    """A distribution as a map from cluster id to frequency."""
    size = F.size(freqs)
    return F.map_from_arrays(F.sequence(F.lit(0), size - 1), freqs)


def reference_distribution(distributions: DataFrame, k: int, window: int = DRIFT_WINDOW) -> DataFrame:
    """The first full window's frequencies, summed and normalised; no row before it is full."""
    sums = [F.sum(_share(c)) for c in range(k)]
    total = reduce(add, sums)
    return (
        distributions.filter(F.col("batch_no") < window)
        .agg(
            F.count(F.lit(1)).alias("n_batches"),
            F.array(*[s / total for s in sums]).alias("freqs"),
        )
        .filter(F.col("n_batches") == window)
        .select("freqs")
    )


def window_distribution(
    distributions: DataFrame,
    k: int,
    window: int = DRIFT_WINDOW,
    batches_per_cell: int = BATCHES_PER_CELL,
) -> DataFrame:
    """Adds ``window_freqs``, the mean of the last ``window`` batches, each counting equally.

    ``batch_no`` must count the non-empty batches from 0. The series is cut into runs of
    batches; each run also receives the last ``window - 1`` batches of the run before, so the
    runs are independent and the frame is exact.
    """
    width = max(batches_per_cell, window)
    run = F.floor(F.col("batch_no") / width)
    in_tail = F.col("batch_no") % width > width - window
    placed = distributions.withColumn(
        "_run", F.explode(F.when(in_tail, F.array(run, run + 1)).otherwise(F.array(run)))
    )
    order = Window.partitionBy("_run").orderBy("batch_no").rowsBetween(1 - window, 0)
    sums = [F.sum(_share(c)).over(order) for c in range(k)]
    return (
        placed.withColumn("_sums", F.array(*sums))
        .filter(F.col("_run") == run)
        .withColumn("_total", F.aggregate("_sums", F.lit(0.0), lambda acc, v: acc + v))
        .withColumn("window_freqs", F.transform("_sums", lambda v: v / F.col("_total")))
        .drop("_run", "_sums", "_total")
    )


def _share(cluster: int) -> Column:
    """A batch's frequency of a cluster; 0 for clusters its model did not have."""
    return F.coalesce(F.get("freqs", F.lit(cluster)), F.lit(0.0))


def kl_divergence(p: Column, q: Column) -> Column:
    """Sum of ``p ln(p / q)`` over the clusters where both are positive."""
    terms = F.zip_with(
        p, q, lambda a, b: F.when((a > 0) & (b > 0), a * F.ln(a / b)).otherwise(0.0)
    )
    return F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)


def js_divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence in nats, held to [0, 1]; its maximum is ln 2."""
    middle = F.zip_with(p, q, lambda a, b: (a + b) / 2)
    value = (kl_divergence(p, middle) + kl_divergence(q, middle)) / 2
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))


def drift_series(
    distributions: DataFrame,
    k: int,
    window: int = DRIFT_WINDOW,
    threshold: float = DRIFT_THRESHOLD,
    reference: DataFrame | None = None,
) -> DataFrame:
    """Drift score per batch: 0 until a window is full, then its divergence from the reference.

    The reference is the first full window unless a stored one (one row, ``freqs``) is given.
    """
    frozen = reference if reference is not None else reference_distribution(distributions, k, window)
    score = F.when(
        F.col("batch_no") >= window - 1, js_divergence(F.col("window_freqs"), F.col("reference"))
    )
    return (
        window_distribution(distributions, k, window)
        .withColumn("reference", frozen.scalar())
        .withColumn("drift_score", F.coalesce(score, F.lit(0.0)))
        .withColumn("is_drift", F.col("drift_score") > threshold)
    )


def drift_events(series: DataFrame, at: Column) -> DataFrame:
    """Event rows of the batches in drift, with the batch's own distribution as current."""
    return series.filter("is_drift").select(
        "batch_no",
        at.alias("detection_time"),
        "drift_score",
        as_map(F.col("reference")).alias("reference_distribution"),
        as_map(F.col("freqs")).alias("current_distribution"),
    )


def align_distributions(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two long distributions ``(cluster_id, freq)`` side by side, 0 where a cluster is absent."""
    p = left.select("cluster_id", F.col("freq").alias("p"))
    q = right.select("cluster_id", F.col("freq").alias("q"))
    return p.join(q, "cluster_id", "full").select(
        "cluster_id",
        F.coalesce("p", F.lit(0.0)).alias("p"),
        F.coalesce("q", F.lit(0.0)).alias("q"),
    )
