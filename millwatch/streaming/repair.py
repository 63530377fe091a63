"""Repair of episodes by readings that arrive behind their machine's last one.

A late reading can begin, extend, split or join episodes. What it can change ends at the machine's next
normal reading, and what it needs from before is one reading with its episode. So only the
readings from just before the first late one to the first normal one after the last are read, from the
days they lie on, and linked again together with the late ones. Readings whose episode changed are written
as corrections, the newest of which holds; the difference to the episodes is written as signed counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.episodes import LINK_COLUMNS, link_episodes
from ..schemas import FAILURES, READINGS, struct
from ..sources import tables

CORRECTIONS = struct(
    reading_id=T.LongType(),
    machine_id=T.StringType(),
    timestamp=T.TimestampType(),
    failure_id=T.LongType(),
    failure_start=T.TimestampType(),
    closes=T.LongType(),
)

# Changes of an episode: readings more or fewer, and, if ``ended`` is set, its end as of ``seq``.
EPISODE_CHANGES = T.StructType(
    [*FAILURES.fields, T.StructField("ended", T.BooleanType()), T.StructField("seq", T.LongType())]
)

_OLD = [f"_old_{c}" for c in LINK_COLUMNS]


def corrected(readings: DataFrame, corrections: DataFrame) -> DataFrame:
    """Stored readings with their newest links."""
    links = F.struct(*LINK_COLUMNS)
    newest = corrections.groupBy("reading_id").agg(F.max_by(links, "batch_id").alias("_links"))
    fixed = F.col("_links").isNotNull()
    links = {c: F.when(fixed, F.col(f"_links.{c}")).otherwise(F.col(c)) for c in LINK_COLUMNS}
    return readings.join(newest, "reading_id", "left").withColumns(links).drop("_links")


@dataclass(frozen=True)
class Region:
    """The readings that late ones may change, without values, and each machine's last reading before them."""

    rows: DataFrame
    before: DataFrame


def region(late: DataFrame, state: DataFrame, root: str, batch_id: int, linked: T.StructType) -> Region:
    """Finds the region of every machine with late readings.

    Its days are read first; machines without a reading before or a normal one after are looked up on
    one, two, four, ... more days. Every machine has a range of days of its own.
    """
    spark = late.sparkSession
    day = lambda c: F.to_date(c)
    known = state.select(
        "machine_id", day("first_seen").alias("first_day"), day("timestamp").alias("last_day"),
        F.col("first_seen").alias("_first"),
    )
    spans = tables.materialise(
        late.groupBy("machine_id")
        .agg(F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"))
        .join(known, "machine_id")
        .withColumns({"lo": day("t0"), "hi": day("t1")}),
        "late-spans",
    )
    step = 1
    while True:
        days = _days(spans)
        stored = tables.read_days(spark, f"{root}/linked", linked, days).filter(F.col("batch_id") < batch_id)
        fixes = tables.read_days(spark, f"{root}/corrections", CORRECTIONS, days)
        fixes = fixes.filter(F.col("batch_id") < batch_id)
        inside = F.to_date("timestamp").between(F.col("lo"), F.col("hi"))
        # written once, without the values, which no link needs: what follows reads these rows several times
        near = corrected(stored.drop("values").join(spans, "machine_id").filter(inside), fixes)
        path = tables.slot(f"{root}/late_region", batch_id)
        near.write.mode("overwrite").parquet(path)
        near = spark.read.schema(near.schema).parquet(path)
        at = F.struct("timestamp", "reading_id")
        ends = near.groupBy("machine_id").agg(
            F.max(F.when(F.col("timestamp") < F.col("t0"), at)).alias("before"),
            F.min(F.when(~F.col("has_failure") & (F.col("timestamp") > F.col("t1")), at)).alias("until"),
        )
        found = tables.materialise(spans.join(ends, "machine_id", "left"), "late-regions")
        no_start = F.col("before").isNull() & (F.col("_first") < F.col("t0")) & (F.col("lo") > F.col("first_day"))
        no_end = F.col("until").isNull() & (F.col("hi") < F.col("last_day"))
        if found.filter(no_start | no_end).isEmpty():
            break
        spans = tables.materialise(
            found.withColumns(
                {
                    "lo": F.when(no_start, F.greatest(F.date_sub("lo", step), "first_day")).otherwise(F.col("lo")),
                    "hi": F.when(no_end, F.least(F.date_add("hi", step), "last_day")).otherwise(F.col("hi")),
                }
            ).drop("before", "until"),
            "late-spans",
        )
        step *= 2
    edges = found.select("machine_id", "before", "until")
    placed = near.join(edges, "machine_id")
    inside = (F.col("timestamp") >= F.col("t0")) & (F.col("until").isNull() | (at <= F.col("until")))
    last = at == F.col("before")
    kept = [f.name for f in READINGS.fields if f.name not in (*LINK_COLUMNS, "values")]
    return Region(
        placed.filter(inside).select(*kept, *LINK_COLUMNS),
        placed.filter(last).select("machine_id", "timestamp", "reading_id", "failure_id", "failure_start"),
    )


def _days(spans: DataFrame) -> list[str]:
    """All days of all ranges; the ranges are as many as their distinct ends."""
    found: set[date] = set()
    for r in spans.select("lo", "hi").distinct().collect():
        found |= {r["lo"] + timedelta(days=k) for k in range((r["hi"] - r["lo"]).days + 1)}
    return sorted(d.isoformat() for d in found)


def relinked(late: DataFrame, found: Region, rows_per_cell: int) -> DataFrame:
    """Late and stored readings of the regions with new links; ``is_new`` tells them apart."""
    renamed = found.rows.withColumnsRenamed(dict(zip(LINK_COLUMNS, _OLD, strict=True)))
    rows = late.withColumn("is_new", F.lit(True)).unionByName(
        renamed.withColumn("is_new", F.lit(False)), allowMissingColumns=True
    )
    return link_episodes(rows, found.before, rows_per_cell)


def corrections(linked: DataFrame) -> DataFrame:
    """The stored readings whose links have changed."""
    same = [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in ("failure_id", "closes")]
    return linked.filter(~F.col("is_new") & ~(same[0] & same[1]))


def episode_changes(linked: DataFrame, seq: Column) -> DataFrame:
    """What the new links change in the episodes.

    A region holds the closing reading of every episode in it, if there is one.
    """
    time, none = T.TimestampType(), F.lit(None)

    def change(episode: str, start: Column, n: int, end: Column) -> Column:
        return F.struct(
            F.col(episode).alias("failure_id"), start.cast(time).alias("start_time"),
            F.lit(n).cast("bigint").alias("n"), end.cast(time).alias("end_time"),
        )

    parts = F.array(
        change("_old_failure_id", F.col("_old_failure_start"), -1, none),
        change("failure_id", F.col("failure_start"), 1, none),
        change("_old_closes", none, 0, none),
        change("closes", none, 0, F.col("timestamp")),
    )
    return (
        linked.select("machine_id", F.inline(parts))
        .filter("failure_id is not null")
        .groupBy("machine_id", "failure_id")
        .agg(
            F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
            F.sum("n").alias("n_readings"),
        )
        .withColumns({"ended": F.lit(True), "seq": seq})
    )
