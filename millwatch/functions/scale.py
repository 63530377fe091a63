"""Helpers that keep jobs balanced and driver-side results small."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

ROWS_PER_CELL = 1_000_000
MAX_CELLS = 100_000
# A cell number holds one group of bits per level of splitting.
CELL_LEVELS = 4
CELL_BITS = 15
BURST_PARTS = 256


def bounded_rows(df: DataFrame, limit: int, what: str) -> list[Row]:
    """Collects a result whose size depends on the model, not on the data; refuses more."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows


@dataclass(frozen=True)
class Cells:
    """Rows tagged with their cell, and the number of cells made by splitting."""

    rows: DataFrame
    n_split: int


def ordered_cells(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "timestamp",
    row_id: str = "reading_id",
    rows_per_cell: int = ROWS_PER_CELL,
    max_cells: int = MAX_CELLS,
) -> Cells:
    """Splits the ordered rows of every large key into contiguous cells of bounded size.

    The column ``cell`` (bigint) sorts like ``(ts, row_id)`` within a key, so a window over
    ``(keys, cell)`` needs only the edges of its neighbours to be exact for the whole key. Keys
    with up to ``rows_per_cell`` rows stay in cell 0. Larger ones are cut into equal time spans,
    numbered from 1; spans that are still too large are cut again, and by ``row_id`` once all
    their timestamps are equal. The cut points sent to the executors number at most
    ``max_cells`` per pass: a pass that would need more raises the cell size instead.

    Costs one aggregation by key, and one more over the rows of large keys per level.
    """
    spark = df.sparkSession
    tick = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = df.withColumn("cell", F.lit(0).cast("bigint"))
    pending = rows
    n_split = 0
    target = rows_per_cell
    for level in range(CELL_LEVELS):
        sizes = pending.groupBy(*keys, "cell").agg(
            F.count(F.lit(1)).alias("n"),
            F.min(tick).alias("t0"),
            F.max(tick).alias("t1"),
            F.min(row_id).alias("i0"),
            F.max(row_id).alias("i1"),
        )
        splittable = sizes.filter("t0 < t1 or i0 < i1")
        heavy = splittable.filter(F.col("n") > target).limit(max_cells + 1).collect()
        while len(heavy) > max_cells:
            target *= 2
            heavy = splittable.filter(F.col("n") > target).limit(max_cells + 1).collect()
        if not heavy:
            break
        cuts = []
        for row in heavy:
            # what is left after an even cut is a burst: cut it finely
            parts = max(-(-row["n"] // target) + 1, BURST_PARTS if level else 1)
            parts = min(parts, 2**CELL_BITS - 3)
            by_time = row["t0"] < row["t1"]
            low, high = (row["t0"], row["t1"]) if by_time else (row["i0"], row["i1"])
            width = (high - low) / parts
            cuts.append((*[row[k] for k in keys], row["cell"], by_time, float(low), width))
            n_split += parts + 1
        if level == 0 and not keys:
            # the whole table is one key: its only cut is part of the expression
            *_, by_time, low, width = cuts[0]
            position = (tick if by_time else F.col(row_id)).cast("double")
            rows = rows.withColumn("cell", _part(position, F.lit(low), F.lit(width)))
            pending = rows
            continue
        fields = [f"{k} {sizes.schema[k].dataType.simpleString()}" for k in keys]
        ddl = ", ".join([*fields, "cell bigint", "by_time boolean", "low double", "width double"])
        cut = F.broadcast(spark.createDataFrame(cuts, ddl))
        # doubles: any rounding keeps the order, so cells stay contiguous
        position = F.when(F.col("by_time"), tick).otherwise(F.col(row_id)).cast("double")
        part = F.coalesce(_part(position, F.col("low"), F.col("width")), F.lit(0))
        rows = (
            rows.join(cut, [*keys, "cell"], "left")
            .withColumn("_cut", F.col("width").isNotNull())
            .withColumn("cell", F.shiftleft("cell", CELL_BITS) + part)
            .select(*df.columns, "cell", "_cut")
        )
        pending = rows.filter("_cut")
        rows = rows.drop("_cut")
    return Cells(rows, n_split)


def _part(position: Column, low: Column, width: Column) -> Column:
    """Number of the span, from 1."""
    return F.floor((position - low) / width).cast("bigint") + 1


def with_global_rank(
    df: DataFrame,
    ts: str = "timestamp",
    row_id: str = "reading_id",
    name: str = "rank",
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Adds the 0-based position of every row in ``(ts, row_id)`` order.

    Rows are numbered inside cells; the offset of a cell is a running sum over the cell sizes,
    a table with at most a few rows per ``rows_per_cell`` input rows.
    """
    cells = ordered_cells(df, [], ts, row_id, rows_per_cell)
    inside = Window.partitionBy("cell").orderBy(ts, row_id)
    numbered = cells.rows.withColumn("_at", F.row_number().over(inside) - 1)
    if not cells.n_split:
        return numbered.withColumn(name, F.col("_at").cast("bigint")).drop("_at", "cell")
    # The sizes are one row per cell, so this single-task window stays small.
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cells.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    if cells.n_split <= 2 * MAX_CELLS:
        offsets = F.broadcast(offsets)
    return (
        numbered.join(offsets, "cell")
        .withColumn(name, (F.col("_off") + F.col("_at")).cast("bigint"))
        .drop("_at", "_off", "cell")
    )


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL when ``whole`` is 0."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double"))
