"""Exactly-once delivery: each message is stored once, and every row that is not is accounted for.

A message is known by a 128-bit hash of its text. A repeat has the time of the first delivery, so it is looked for among
the known messages of its day, not of all time, and is found however late it comes. Rows behind the watermark, if one is
asked for, go to a table of their own. Kept, repeated and late rows add up to the accepted ones.

All tables are written under the micro-batch id; a repeated micro-batch replaces its own rows and reads
only what came before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import struct
from ..sources import tables

DELIVERED = struct(
    key=T.StringType(),
    machine_id=T.StringType(),
    timestamp=T.TimestampType(),
    n=T.LongType(),
    is_new=T.BooleanType(),
)
LATE = struct(raw=T.StringType(), machine_id=T.StringType(), timestamp=T.TimestampType())
PROGRESS = struct(latest=T.TimestampType())


def keep_once(
    accepted: DataFrame, batch_id: int, root: str, delay_minutes: int | None = None
) -> DataFrame:
    """The rows of a micro-batch of accepted messages that no earlier row delivered, one per message.

    With ``delay_minutes`` rows older than the latest time of all earlier micro-batches by more than that go to
    the table ``late``, known or not. Without it nothing is late. Of repeats in one micro-batch the one of the lowest
    partition and offset stays, where there are any. Copies are counted before they are shuffled, so
    a message delivered very often is no hot key.
    """
    spark = accepted.sparkSession
    # decoded once: what follows reads these rows several times
    path = tables.slot(f"{root}/delivery_input", batch_id)
    accepted.write.mode("overwrite").parquet(path)
    accepted = spark.read.schema(accepted.schema).parquet(path)
    on_time = accepted
    if delay_minutes is not None:
        latest = _latest(spark, root, batch_id)
        newest = accepted.agg(F.max("timestamp").alias("latest"))
        if latest is not None:
            newest = newest.select(F.greatest("latest", F.lit(latest)).alias("latest"))
            behind = F.col("timestamp") < F.lit(latest) - F.make_dt_interval(mins=F.lit(delay_minutes))
            on_time = accepted.filter(~behind)
            tables.write_batch(accepted.filter(behind), f"{root}/late", batch_id, LATE, by_date="timestamp")
    known = tables.read_days(spark, f"{root}/delivered", DELIVERED, tables.days_of(on_time))
    known = known.filter((F.col("batch_id") < batch_id) & F.col("is_new"))
    columns = on_time.columns
    place = [c for c in ("partition", "offset") if c in columns]
    row = F.struct(*columns)
    found = (
        on_time.groupBy(F.md5(F.col("raw").cast("binary")).alias("key"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.min_by(row, F.struct(*place)) if place else F.first(row)).alias("row"),
        )
        .join(known.select("key", F.lit(True).alias("_known")), "key", "left")
        .select("key", "n", F.col("_known").isNull().alias("is_new"), "row.*")
    )
    path = tables.slot(f"{root}/delivery", batch_id)
    found.write.mode("overwrite").parquet(path)
    stored = spark.read.schema(found.schema).parquet(path)
    tables.write_batch(stored, f"{root}/delivered", batch_id, DELIVERED, by_date="timestamp")
    if delay_minutes is not None:
        newest.write.mode("overwrite").parquet(tables.slot(f"{root}/delivery_state", batch_id))
    return stored.filter("is_new").select(*columns)


def _latest(spark: SparkSession, root: str, batch_id: int):
    """The latest time of the micro-batches before; a lost state is an error."""
    if batch_id == 0:
        return None
    path = tables.slot(f"{root}/delivery_state", batch_id - 1)
    return spark.read.schema(PROGRESS).parquet(path).agg(F.max("latest")).first()[0]


def totals(spark: SparkSession, root: str) -> DataFrame:
    """Per machine the messages kept, their repeats and the rows behind the watermark."""
    delivered = tables.read_batches(spark, f"{root}/delivered", DELIVERED, by_date=True)
    late = tables.read_batches(spark, f"{root}/late", LATE, by_date=True)
    new, none = F.col("is_new").cast("bigint"), F.lit(0).cast("bigint")
    rows = delivered.select("machine_id", new.alias("kept"), (F.col("n") - new).alias("repeats"), none.alias("late"))
    rows = rows.unionByName(
        late.select("machine_id", none.alias("kept"), none.alias("repeats"), F.lit(1).cast("bigint").alias("late"))
    )
    return rows.groupBy("machine_id").agg(*[F.sum(c).alias(c) for c in ("kept", "repeats", "late")])
