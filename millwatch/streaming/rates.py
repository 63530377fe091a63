"""Event-time rates and duplicate removal on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_rates(
    events: DataFrame, ts: str = "timestamp", keys: Sequence[str] = (), delay: str = "10 minutes"
) -> DataFrame:
    """Rows per minute and key; a minute is final once the watermark has passed it.

    In ``update`` mode a trigger also gives the minutes that are still open.
    """
    return (
        events.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 minute"), *keys)
        .agg(F.count(F.lit(1)).alias("per_minute"))
        .select(F.col("window.start").alias("minute"), *keys, "per_minute")
    )


def drop_repeats(
    readings: DataFrame, delay: str = "10 minutes", keys: Sequence[str] = ("raw",)
) -> DataFrame:
    """Removes messages delivered again within ``delay``.

    Repeats are equal as messages; two different readings of one instant both stay.
    """
    return readings.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(keys))
