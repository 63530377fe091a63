"""Model registry and version signals; tables of one row per training run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_model(clusters: DataFrame, newest_by: str = "id") -> DataFrame:
    """The active row with the highest ``newest_by``: ``id`` to load, ``created_at`` to label."""
    return clusters.filter("is_active").orderBy(F.col(newest_by).desc(), F.col("id").desc()).limit(1)


def switch_model(clusters: DataFrame) -> DataFrame:
    """Only the newest row stays active."""
    newest = clusters.agg(F.max("id")).scalar()
    return clusters.withColumn("is_active", F.col("id") == newest)


def pending_version(versions: DataFrame) -> DataFrame:
    """The newest signal that nobody has picked up."""
    return (
        versions.filter(~F.col("is_processed"))
        .orderBy(F.col("created_at").desc(), F.col("id").desc())
        .limit(1)
    )


def mark_processed(versions: DataFrame, all_pending: bool = False) -> DataFrame:
    """Marks the newest pending signal, or every pending one, as picked up."""
    if all_pending:
        return versions.withColumn("is_processed", F.lit(True))
    newest = pending_version(versions).select("id").scalar()
    return versions.withColumn(
        "is_processed", F.col("is_processed") | F.coalesce(F.col("id") == newest, F.lit(False))
    )


def next_id(table: DataFrame) -> int:
    return (table.agg(F.max("id")).first()[0] or 0) + 1
