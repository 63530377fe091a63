"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import keep, remove


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, comp``: every node of an edge with the smallest node it can reach.

    Each round takes the smallest label among neighbours and then the label of that label, so
    the distance covered doubles. Labels are stored after every round; only the number of changed
    labels comes to the driver. Repeated edges, loops and an empty table are fine.
    """
    spark = edges.sparkSession
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).union(
        edges.select(F.col(b), F.col(a))
    )
    both, own = keep(both.distinct(), "edges")
    label, path = keep(
        both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("comp")),
        "labels",
    )
    while True:
        near = (
            both.join(label.withColumnRenamed("node", "other"), "other")
            .groupBy("node")
            .agg(F.min("comp").alias("near"))
        )
        step = label.join(near, "node", "left").select(
            "node", F.col("comp").alias("was"), F.least("comp", "near").alias("to")
        )
        jump = label.select(F.col("node").alias("to"), F.col("comp").alias("beyond"))
        moved = step.join(jump, "to", "left").select("node", "was", F.least("to", "beyond").alias("comp"))
        after, new_path = keep(moved, "labels")
        remove(spark, path)
        label, path = after.select("node", "comp"), new_path
        if after.filter(F.col("was") != F.col("comp")).isEmpty():
            remove(spark, own)
            return label
