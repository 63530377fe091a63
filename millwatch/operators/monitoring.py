"""Dashboard queries over predictions and scoring latencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed import SCORING_LATENCY_BOUNDS
from ..functions.scale import ratio


def rate_per_minute(
    events: DataFrame, ts: str = "timestamp", keys: Sequence[str] = (), slide: str | None = None
) -> DataFrame:
    """Rows per one-minute window, tumbling or every ``slide``."""
    return (
        events.groupBy(F.window(ts, "1 minute", slide), *keys)
        .agg(F.count(F.lit(1)).alias("per_minute"))
        .select(F.col("window.start").alias("minute"), *keys, "per_minute")
    )


def cumulative_total(per_minute: DataFrame) -> DataFrame:
    """Running total of a per-minute series.

    The series has one row per minute of history whatever the traffic, about half a million a
    year, so one ordered pass is enough.
    """
    so_far = Window.orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    return per_minute.withColumn("total", F.sum("per_minute").over(so_far))


def cluster_share(predictions: DataFrame) -> DataFrame:
    """Predictions per cluster and their share of all."""
    counts = predictions.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def latency_histogram(
    latencies: DataFrame,
    column: str = "latency",
    keys: Sequence[str] = (),
    bounds: Sequence[float] = SCORING_LATENCY_BOUNDS,
) -> DataFrame:
    """Cumulative bucket counts, sum and count, as one row per key."""
    value = F.col(column)
    cumulative = [F.count_if(value <= b) for b in bounds]
    return latencies.groupBy(*keys).agg(
        F.array(*cumulative, F.count(value)).alias("buckets"),
        F.sum(value).alias("latency_sum"),
        F.count(value).alias("latency_count"),
    )


def histogram_rows(
    histogram: DataFrame, bounds: Sequence[float] = SCORING_LATENCY_BOUNDS
) -> DataFrame:
    """One row per bucket; ``le`` is the bound as text, ``+Inf`` for the last."""
    labels = F.array(*[F.lit(str(b)) for b in bounds], F.lit("+Inf"))
    keys = [c for c in histogram.columns if c not in ("buckets",)]
    return histogram.select(*keys, F.posexplode("buckets").alias("pos", "n")).select(
        *keys, F.element_at(labels, F.col("pos") + 1).alias("le"), "n"
    )


def mean_latency(histogram: DataFrame) -> DataFrame:
    return histogram.withColumn(
        "mean_latency", ratio(F.col("latency_sum"), F.col("latency_count"))
    )


def histogram_quantile(
    buckets: Column, q: float, bounds: Sequence[float] = SCORING_LATENCY_BOUNDS
) -> Column:
    """Quantile by linear interpolation inside its bucket.

    The first bucket starts at 0; a quantile beyond the last finite bound is that bound.
    """
    n = len(bounds)
    rank = F.element_at(buckets, n + 1) * F.lit(q)
    found = F.lit(None).cast("double")
    for i in range(n, -1, -1):
        upper_count = buckets[i]
        if i == n:
            value = F.lit(float(bounds[-1]))
        else:
            low = F.lit(float(bounds[i - 1]) if i else 0.0)
            low_count = buckets[i - 1] if i else F.lit(0)
            width = F.lit(float(bounds[i])) - low
            inside = upper_count - low_count
            value = F.when(inside == 0, low + width).otherwise(
                low + width * (rank - low_count) / inside
            )
        found = F.when(upper_count >= rank, value).otherwise(found)
    return F.when(F.element_at(buckets, n + 1) > 0, found)


def band(value: Column, bands: Sequence[tuple[str, float | None]]) -> Column:
    """The colour of the highest band whose lower bound the value reaches."""
    colour = F.lit(bands[0][0])
    for name, bound in bands[1:]:
        colour = F.when(value >= bound, name).otherwise(colour)
    return colour


def trailing(events: DataFrame, as_of: Column, hours: int, ts: str = "timestamp") -> DataFrame:
    """Rows of the last ``hours`` up to and including ``as_of``."""
    start = as_of - F.make_dt_interval(hours=F.lit(hours))
    return events.filter((F.col(ts) >= start) & (F.col(ts) <= as_of))


def series_summary(series: DataFrame, order: str, value: str) -> DataFrame:
    """Last non-null value, mean and maximum of a series."""
    known = F.col(value).isNotNull()
    return series.agg(
        F.max_by(F.col(value), F.when(known, F.col(order))).alias("last_value"),
        F.avg(value).alias("mean_value"),
        F.max(value).alias("max_value"),
    )
