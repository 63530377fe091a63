"""Continuous ingest: messages to readings, machines and failures.

Every micro-batch runs the batch operators, continuing from one state row per machine. A machine
that sends most of a micro-batch is split like in batch, which a per-key state function could not
do. Each table part is written under the micro-batch id, so a repeated batch replaces itself.

The work of a micro-batch follows its own rows and not the age of the tables: the state lies in buckets of
machines of which only the touched ones are read and written, readings are looked up by day, and
changes of episodes are appended and merged into a table by day every ``compact_every`` micro-batches.
Commit files name the live parts, so no folder of past micro-batches is listed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scale import ROWS_PER_CELL
from ..operators.episodes import link_episodes
from ..schemas import FAILURES, MACHINES, READINGS, struct
from ..sources import messages, tables
from ..sources.commits import Commits, Folder
from . import delivery, repair

# Buckets of machines in which the state is written.
BUCKETS = 32
# Micro-batches between two compactions of the episodes.
COMPACT_EVERY = 32

REJECTED = struct(raw=T.StringType(), reason=T.StringType())

LINKED = T.StructType(
    [
        *READINGS.fields,
        T.StructField("closes", T.LongType()),
        T.StructField("late", T.BooleanType()),
    ]
)

# Sightings and last reading of each machine, with the episode open at that point.
STATE = T.StructType(
    [
        *MACHINES.fields,
        *[READINGS[name] for name in ("timestamp", "reading_id", "failure_id", "failure_start")],
    ]
)


def start_ingest(
    raw: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
    compact_every: int = COMPACT_EVERY,
    once: bool = False,
) -> StreamingQuery:
    """Starts the ingest of a message stream into the tables below ``root``.

    With ``once`` messages delivered again are counted in the table ``delivered`` and not stored again.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, root, rows_per_cell, compact_every, once)

    return (
        raw.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    rows_per_cell: int = ROWS_PER_CELL,
    compact_every: int = COMPACT_EVERY,
    once: bool = False,
) -> None:
    """Decodes, links and stores one micro-batch; what cannot be decoded is kept with its reason.

    Every valid reading is stored. One whose time lies before its machine's latest stored reading
    is ``late`` and repairs the episodes it falls among (:mod:`.repair`). Readings at the same instant as the latest
    are not late. Only the buckets of the state that hold machines of the batch are read and written.
    """
    spark = batch.sparkSession
    states = Commits(spark, f"{root}/state/_commits")
    if states.exists(f"{batch_id + 1:020d}.json"):
        raise RuntimeError(f"{root} holds later micro-batches than {batch_id}: a new checkpoint needs a new root")
    decoded = messages.decode(batch).persist()
    try:
        tables.write_batch(messages.rejected(decoded), f"{root}/rejected", batch_id, REJECTED)
        valid = messages.accepted(decoded)
        if once:
            valid = delivery.keep_once(valid, batch_id, root)
        numbered = messages.with_reading_id(valid, batch_id)
        touched, days = _places(valid)
        state = read_state(spark, root, batch_id - 1, touched)
        known = state.select("machine_id", F.col("timestamp").alias("_last"))
        # one row per machine on the right: a hot machine's readings may be split by the join
        placed = (
            numbered.drop("raw", "n_bad_values")
            .join(known, "machine_id", "left")
            .withColumn("late", F.coalesce(F.col("timestamp") < F.col("_last"), F.lit(False)))
            .drop("_last")
        )
        # numbered once: what follows reads these rows several times
        path = tables.slot(f"{root}/arrived", batch_id)
        placed.write.mode("overwrite").parquet(path)
        placed = spark.read.schema(placed.schema).parquet(path)
        on_time, late = placed.filter(~F.col("late")), placed.filter("late")
        repaired = None
        if not late.isEmpty():
            region = repair.region(late, state, root, batch_id, LINKED)
            path = tables.slot(f"{root}/repaired", batch_id)
            repair.relinked(late, region, rows_per_cell).write.mode("overwrite").parquet(path)
            repaired = spark.read.parquet(path)
            # one row per machine, written once: it is read by the link, the changes and the next state
            path = tables.slot(f"{root}/repaired_state", batch_id)
            next_state(state, repaired).write.mode("overwrite").parquet(path)
            state = spark.read.schema(STATE).parquet(path)
            fixes = repair.corrections(repaired)
            tables.write_batch(fixes, f"{root}/corrections", batch_id, repair.CORRECTIONS, by_date="timestamp")
        carried = state.join(on_time.select("machine_id").distinct(), "machine_id", "left_semi")
        linked = link_episodes(on_time, carried, rows_per_cell)
        if repaired is not None:
            linked = linked.unionByName(repaired.filter("is_new").select(*linked.columns))
        tables.write_batch(linked, f"{root}/linked", batch_id, LINKED, by_date="timestamp")
        stored = tables.read_days(spark, f"{root}/linked", LINKED, days, batch_id).filter(~F.col("late"))
        changes = episode_changes(stored, state, 2 * batch_id + 1)
        if repaired is not None:
            changes = changes.unionByName(repair.episode_changes(repaired, F.lit(2 * batch_id)))
        write_changes(changes, root, batch_id)
        write_state(next_state(state, stored), root, batch_id, touched)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_failures(spark, root, batch_id)
    finally:
        decoded.unpersist()


def bucket_of(machine: str) -> Column:
    return F.pmod(F.xxhash64(machine), F.lit(BUCKETS)).cast("int").alias("bucket")


def _places(readings: DataFrame) -> tuple[list[int], list[str]]:
    """Buckets of the machines and days that the readings of one micro-batch fall on, found in one pass."""
    places = readings.select(bucket_of("machine_id"), F.to_date("timestamp").alias("day"))
    found = places.agg(F.collect_set("bucket"), F.collect_set("day")).first()
    return sorted(found[0]), sorted(d.isoformat() for d in found[1])


def next_state(state: DataFrame, linked: DataFrame) -> DataFrame:
    """The state after the given readings; machines without new readings keep theirs.

    A reading that was linked again replaces what the state says of it.
    """
    at = F.struct("timestamp", "reading_id", "_step")
    fresh = linked.select(
        "machine_id",
        F.col("timestamp").alias("first_seen"),
        F.col("timestamp").alias("last_seen"),
        "timestamp",
        "reading_id",
        "failure_id",
        "failure_start",
        F.lit(1).alias("_step"),
    )
    return tables.conform(
        state.withColumn("_step", F.lit(0))
        .unionByName(fresh)
        .groupBy("machine_id")
        .agg(
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
            F.max_by(F.struct("timestamp", "reading_id", "failure_id", "failure_start"), at).alias(
                "_last"
            ),
        )
        .select("machine_id", "first_seen", "last_seen", "_last.*"),
        STATE,
    )


def read_state(
    spark: SparkSession, root: str, batch_id: int, buckets: Sequence[int] | None = None
) -> DataFrame:
    """State after ``batch_id``, of the given buckets of machines or all.

    The commit names the micro-batch that wrote each bucket last, so nothing is listed. Only before the
    first micro-batch there may be none.
    """
    if batch_id < 0:
        return spark.createDataFrame([], STATE)
    live = Commits(spark, f"{root}/state/_commits").get(batch_id)
    wanted = live if buckets is None else [str(b) for b in buckets if str(b) in live]
    paths = [f"{root}/state/bucket={b}/batch_id={live[b]}" for b in wanted]
    return spark.read.schema(STATE).parquet(*paths) if paths else spark.createDataFrame([], STATE)


def write_state(state: DataFrame, root: str, batch_id: int, touched: Sequence[int]) -> None:
    """Writes the touched buckets and commits; versions that no repeated micro-batch can need are deleted."""
    spark = state.sparkSession
    commits = Commits(spark, f"{root}/state/_commits")
    live = commits.get(batch_id - 1) if batch_id else {}
    (
        state.withColumns({"bucket": bucket_of("machine_id"), "batch_id": F.lit(batch_id)})
        .repartition("bucket")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("bucket", "batch_id")
        .parquet(f"{root}/state")
    )
    commits.replace(batch_id, live | {str(b): batch_id for b in touched})
    if batch_id > 1:
        older = commits.get(batch_id - 2) if commits.exists(f"{batch_id - 2:020d}.json") else {}
        Folder(spark, f"{root}/state").delete(
            *[f"bucket={b}/batch_id={n}" for b, n in older.items() if live.get(b) != n]
        )
        commits.delete(f"{batch_id - 2:020d}.json")


def episode_changes(stored: DataFrame, state: DataFrame, seq: int) -> DataFrame:
    """What new readings add to episodes, each with the start of its episode."""
    failing = F.col("failure_id").isNotNull()
    open_before = state.filter("failure_id is not null").select(
        "machine_id", "failure_id", F.col("failure_start").alias("_start")
    )
    return (
        stored.withColumn("_episode", F.coalesce("failure_id", "closes"))
        .filter(F.col("_episode").isNotNull())
        .groupBy("machine_id", F.col("_episode").alias("failure_id"))
        .agg(
            F.min("failure_start").alias("start_time"),
            F.max(F.when(~failing, F.col("timestamp"))).alias("end_time"),
            F.count_if(failing).alias("n_readings"),
        )
        .join(open_before, ["machine_id", "failure_id"], "left")
        .withColumn("start_time", F.coalesce("start_time", "_start"))
        .drop("_start")
        .withColumns({"ended": F.col("end_time").isNotNull(), "seq": F.lit(seq).cast("bigint")})
    )


def write_changes(changes: DataFrame, root: str, batch_id: int) -> None:
    out = tables.conform(changes, repair.EPISODE_CHANGES)
    out.write.mode("overwrite").parquet(f"{root}/failures/changes/batch_id={batch_id}")


def merge_changes(changes: DataFrame) -> DataFrame:
    """One row per episode from changes in any order; episodes without readings are gone."""
    end = F.struct("seq", "end_time")
    return (
        changes.groupBy("machine_id", "failure_id")
        .agg(
            F.min("start_time").alias("start_time"),
            F.max(F.when(F.col("ended"), end)).alias("_end"),
            F.sum("n_readings").alias("n_readings"),
        )
        .filter("n_readings > 0")
        .select(
            "machine_id", "failure_id", "start_time", F.col("_end.end_time").alias("end_time"),
            F.col("_end.end_time").isNull().alias("is_active"), "n_readings",
            F.col("_end").isNotNull().alias("ended"), F.col("_end.seq").alias("seq"),
        )
    )


def compact_failures(spark: SparkSession, root: str, upto: int) -> None:
    """Merges the changes up to a micro-batch into the table of episodes, laid out by the day they began.

    Only days with changes are written anew, under the number of this commit; the commit then names the
    live version of every day. Until it is there, readers see the version before with its changes, so a
    run that dies leaves nothing but files that nobody reads. Changes and versions are deleted by the
    next compaction, when no reader uses them any more.
    """
    commits = Commits(spark, f"{root}/failures/_commits")
    last, live = commits.newest()
    if last >= upto:
        return
    live = live or {"days": {}, "gone": []}
    changes = _changes(spark, root, last + 1, upto)
    day = F.coalesce(F.to_date("start_time").cast("string"), F.lit("none"))
    days = sorted(r[0] for r in changes.select(day).distinct().collect())
    old = [f"{root}/failures/base/version={live['days'][d]}/day={d}" for d in days if d in live["days"]]
    if old:
        changes = changes.unionByName(spark.read.schema(repair.EPISODE_CHANGES).parquet(*old))
    merged = tables.conform(merge_changes(changes), repair.EPISODE_CHANGES).withColumn("day", day)
    path = f"{root}/failures/base/version={upto}"
    merged.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)
    written = set(Folder(spark, path).names())
    kept = {d: v for d, v in live["days"].items() if d not in days}
    kept |= {d: upto for d in days if f"day={d}" in written}
    gone = [f"base/version={live['days'][d]}/day={d}" for d in days if d in live["days"]]
    gone += [f"changes/batch_id={n}" for n in range(last + 1, upto + 1)]
    commits.replace(upto, {"days": kept, "gone": gone})
    Folder(spark, f"{root}/failures").delete(*live["gone"])
    commits.delete(*[f"{n:020d}.json" for n in commits.numbers() if n < last])


def _changes(spark: SparkSession, root: str, first: int, last: int | None = None) -> DataFrame:
    """Changes of the micro-batches from ``first`` on; their folders are known by number."""
    folder, paths = Folder(spark, f"{root}/failures/changes"), []
    n = first
    while folder.exists(f"batch_id={n}/_SUCCESS") and (last is None or n <= last):
        paths.append(f"{folder.path}/batch_id={n}")
        n += 1
    if last is not None and n <= last:
        raise FileNotFoundError(f"{folder.path}/batch_id={n} does not exist")
    empty = spark.createDataFrame([], repair.EPISODE_CHANGES)
    return spark.read.schema(repair.EPISODE_CHANGES).parquet(*paths) if paths else empty


def current_readings(spark: SparkSession, root: str) -> DataFrame:
    """All readings with their episodes as they are known now."""
    stored = tables.read_batches(spark, f"{root}/linked", LINKED, by_date=True)
    fixes = tables.read_batches(spark, f"{root}/corrections", repair.CORRECTIONS, by_date=True)
    return repair.corrected(stored, fixes)


def current_failures(spark: SparkSession, root: str) -> DataFrame:
    """Episodes of the last compaction, merged with the changes since."""
    last, live = Commits(spark, f"{root}/failures/_commits").newest()
    changes = _changes(spark, root, last + 1)
    if live and live["days"]:
        base = [f"{root}/failures/base/version={v}/day={d}" for d, v in live["days"].items()]
        changes = changes.unionByName(spark.read.schema(repair.EPISODE_CHANGES).parquet(*base))
    return tables.conform(merge_changes(changes), FAILURES)


def current_machines(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    return tables.conform(read_state(spark, root, batch_id), MACHINES)
