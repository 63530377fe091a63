"""Failure episodes: gaps and islands per machine, exact for machines of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scale import MAX_CELLS, ROWS_PER_CELL, ordered_cells
from ..sources.tables import materialise

RUN = "struct<id: bigint, start: timestamp>"
LINK_COLUMNS = ("failure_id", "failure_start", "closes")


def link_episodes(
    readings: DataFrame, carried: DataFrame | None = None, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Adds ``failure_id`` and ``failure_start`` to failing readings, ``closes`` to those that end one.

    In ``(timestamp, reading_id)`` order per machine, a failing reading opens an episode unless
    one is open; the next normal reading closes it. An episode is named after the reading that
    opened it, so ids are the same in every run and on every retry.

    ``carried`` continues an earlier run: one row per machine ``(machine_id, timestamp,
    reading_id, failure_id, failure_start)`` with its last reading and the episode open then.
    It takes part as the machine's first row and is not returned.

    One shuffle by machine. Machines above ``rows_per_cell`` readings are cut into time cells
    (:func:`ordered_cells`) that run in parallel; only the edges of their cells are compared
    across, in a table of one row per cell.
    """
    columns = readings.columns
    rows, seeds = readings, None
    if carried is not None:
        rows = readings.withColumn("_open", F.lit(None).cast(RUN)).withColumn("_seed", F.lit(False))
        seeds = carried.select(
            "machine_id",
            "timestamp",
            "reading_id",
            F.col("failure_id").isNotNull().alias("has_failure"),
            F.struct(F.col("failure_id").alias("id"), F.col("failure_start").alias("start"))
            .cast(RUN)
            .alias("_open"),
            F.lit(True).alias("_seed"),
        )
        rows = rows.unionByName(seeds, allowMissingColumns=True)

    cells = ordered_cells(rows, ["machine_id"], rows_per_cell=rows_per_cell)
    order = Window.partitionBy("machine_id", "cell").orderBy("timestamp", "reading_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    failing = F.col("has_failure")
    opened = F.struct(F.col("reading_id").alias("id"), F.col("timestamp").alias("start"))
    if carried is not None:
        opened = F.coalesce(F.col("_open"), opened)
    before = F.col("_before")
    begins = failing & ~F.coalesce(before, F.lit(False))
    local = cells.rows.withColumn("_before", F.lag("has_failure").over(order)).withColumn(
        "_run", F.last(F.when(begins, opened), ignorenulls=True).over(so_far)
    )
    run = F.col("_run")
    if not cells.n_split:
        owner, was_failing = run, before
        linked = local
    else:
        carries = _carry_between_cells(cells.rows, cells.n_split, seeds)
        linked = local.join(carries, ["machine_id", "cell"], "left")
        carry, edge = F.col("_carry"), F.col("_edge")
        # a run that starts with its cell belongs to the episode still open in the cell before
        owner = F.when(carry.isNotNull() & (run.isNull() | (run["id"] == edge["id"])), carry).otherwise(run)
        was_failing = F.coalesce(before, carry.isNotNull())
    linked = (
        linked.withColumn("failure_id", F.when(failing, owner["id"]))
        .withColumn("failure_start", F.when(failing, owner["start"]))
        .withColumn("closes", F.when(~failing & was_failing, owner["id"]))
    )
    if carried is not None:
        linked = linked.filter(~F.col("_seed"))
    kept = [c for c in columns if c not in LINK_COLUMNS]
    return linked.select(*kept, *LINK_COLUMNS)


def _carry_between_cells(rows: DataFrame, n_split: int, seeds: DataFrame | None) -> DataFrame:
    """Per cell of a split machine: its edge run and the episode open when the cell begins.

    A cell that ends normal passes on nothing, one that ends in a run begun inside it passes on
    that run, and one that fails throughout passes on what it received or, after a normal end,
    its own run. The edges come from aggregations that are combined before their shuffle; no
    reading is moved or sorted for them.
    """
    split = rows.filter(F.col("cell") > 0).withColumn("_at", _position())
    failing, at = F.col("has_failure"), F.col("_at")
    edges = materialise(
        split.groupBy("machine_id", "cell").agg(
            F.min(F.when(failing, at)).alias("first_failing"),
            F.max(F.when(failing, at)).alias("last_failing"),
            F.min(F.when(~failing, at)).alias("first_normal"),
            F.max(F.when(~failing, at)).alias("last_normal"),
        ),
        "cell-edges",
    )
    small = n_split <= 2 * MAX_CELLS
    open_ended = edges.filter("last_failing > last_normal").select(
        "machine_id", "cell", "last_normal"
    )
    begun_inside = (
        split.filter(failing)
        .join(F.broadcast(open_ended) if small else open_ended, ["machine_id", "cell"])
        .filter(at > F.col("last_normal"))
        .groupBy("machine_id", "cell")
        .agg(F.min("_at").alias("_begun"))
    )
    all_failing = F.col("last_normal").isNull()
    ends_failing = all_failing | F.coalesce(F.expr("last_failing > last_normal"), F.lit(False))
    begins_failing = all_failing | F.coalesce(F.expr("first_failing < first_normal"), F.lit(False))
    cells = edges.join(begun_inside, ["machine_id", "cell"], "left").select(
        "machine_id",
        "cell",
        all_failing.alias("_all_failing"),
        ends_failing.alias("_ends_failing"),
        F.when(begins_failing, F.col("first_failing")).alias("_edge_at"),
        F.when(all_failing, F.col("first_failing")).otherwise(F.col("_begun")).alias("_last_at"),
    )
    cells = cells.withColumn("_edge", _run_at("_edge_at")).withColumn(
        "_last_run", _run_at("_last_at")
    )
    if seeds is not None:
        # a run that begins with the carried row is the episode it carries
        named = seeds.select(
            "machine_id", F.col("reading_id").alias("_seed_id"), F.col("_open").alias("_carried")
        )
        is_seed = F.col("_last_run.id") == F.col("_seed_id")
        cells = cells.join(named, "machine_id", "left").withColumn(
            "_last_run", F.when(is_seed, F.col("_carried")).otherwise(F.col("_last_run"))
        )
    order = Window.partitionBy("machine_id").orderBy("cell")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    follows_failing = F.coalesce(F.lag("_ends_failing").over(order), F.lit(False))
    passes = (
        F.when(~F.col("_ends_failing"), F.struct(F.lit(None).cast(RUN).alias("run")))
        .when(~F.col("_all_failing") | ~follows_failing, F.struct(F.col("_last_run").alias("run")))
    )
    carry = cells.withColumn("_passes", passes).select(
        "machine_id",
        "cell",
        "_edge",
        F.last("_passes", ignorenulls=True).over(earlier)["run"].alias("_carry"),
    )
    return F.broadcast(carry) if small else carry


def _position() -> Column:
    """A reading's place in ``(timestamp, reading_id)`` order as one number.

    Numbers, unlike structs, can be aggregated by hash. The offsets keep both parts positive.
    """
    return F.expr(
        "(cast(unix_micros(timestamp) as decimal(20, 0)) + 4611686018427387904BD)"
        " * 18446744073709551616BD + (cast(reading_id as decimal(20, 0)) + 9223372036854775808BD)"
    )


def _run_at(name: str) -> Column:
    """The run begun by the reading whose position is in column ``name``, NULL without one."""
    tick = f"({name} div 18446744073709551616BD)"
    row_id = (
        f"cast({name} - cast({tick} as decimal(20, 0)) * 18446744073709551616BD"
        " - 9223372036854775808BD as bigint)"
    )
    start = f"timestamp_micros({tick} - 4611686018427387904L)"
    return F.expr(
        f"CASE WHEN {name} IS NOT NULL THEN named_struct('id', {row_id}, 'start', {start}) END"
    )


def failures(linked: DataFrame) -> DataFrame:
    """One row per episode; ``end_time`` is the closing reading's time, NULL while open."""
    failing = F.col("failure_id").isNotNull()
    return (
        linked.withColumn("_episode", F.coalesce("failure_id", "closes"))
        .filter(F.col("_episode").isNotNull())
        .groupBy("machine_id", F.col("_episode").alias("failure_id"))
        .agg(
            F.min(F.when(failing, F.col("timestamp"))).alias("start_time"),
            F.max(F.when(~failing, F.col("timestamp"))).alias("end_time"),
            F.count_if(failing).alias("n_readings"),
        )
        .withColumn("is_active", F.col("end_time").isNull())
    )


def merge_failures(deltas: DataFrame) -> DataFrame:
    """Current failures from the partial rows that successive batches wrote."""
    return (
        deltas.groupBy("machine_id", "failure_id")
        .agg(
            F.min("start_time").alias("start_time"),
            F.max("end_time").alias("end_time"),
            F.sum("n_readings").alias("n_readings"),
        )
        .withColumn("is_active", F.col("end_time").isNull())
    )


def machines(readings: DataFrame) -> DataFrame:
    """First and last event time per machine."""
    return readings.groupBy("machine_id").agg(
        F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen")
    )


def merge_machines(*parts: DataFrame) -> DataFrame:
    """Machine tables combined: earliest first and latest last sighting."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.groupBy("machine_id").agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )


def failure_counters(episodes: DataFrame) -> DataFrame:
    """Episodes started and still active, per machine."""
    return episodes.groupBy("machine_id").agg(
        F.count(F.lit(1)).alias("n_started"), F.count_if("is_active").alias("n_active")
    )


def in_lookback(
    rows: DataFrame, as_of: Column, hours: int, column: str = "start_time"
) -> DataFrame:
    """Rows whose episode started within ``hours`` before ``as_of``, which is itself excluded.

    On linked readings use ``column="failure_start"``: no join with the episodes is needed.
    """
    start = F.col(column)
    return rows.filter(
        (start >= as_of - F.make_dt_interval(hours=F.lit(hours))) & (start < as_of)
    )


def episode_readings(
    episodes: DataFrame | None, linked: DataFrame, machine_table: DataFrame
) -> DataFrame:
    """Readings of the given episodes with their machine; episodes without readings drop out.

    Without ``episodes`` all of them are meant: the start that the readings carry then saves the join.
    """
    members = linked.filter(F.col("failure_id").isNotNull()).drop("closes")
    if episodes is None:
        started = members.withColumnRenamed("failure_start", "start_time")
    else:
        started = members.drop("failure_start").join(
            episodes.select("machine_id", "failure_id", "start_time"), ["machine_id", "failure_id"]
        )
    return started.join(machine_table, "machine_id")
