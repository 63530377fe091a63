"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "millwatch", **conf: str) -> SparkSession:
    """A session with the settings the package relies on.

    On a cluster leave ``master`` and the memory settings to spark-submit; AQE sizes the
    shuffle partitions, splits skewed joins and turns small joins into broadcasts.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session whose driver is its one executor may fall back to a temporary folder, as in
    tests: elsewhere, also on ``local-cluster``, the executors do not share one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not single_process(spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_root(spark.sparkContext.applicationId)


def single_process(master: str) -> bool:
    """Whether driver and executor are one process."""
    return master == "local" or master.startswith("local[")


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"millwatch-{application}-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that nobody else uses."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
