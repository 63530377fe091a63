"""The labeled reference table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import SENSOR_PREFIX


def labeled_schema(header: list[str]) -> T.StructType:
    """Doubles for sensors and the label, text for anything else."""
    return T.StructType(
        [
            T.StructField(
                name,
                T.DoubleType()
                if name.startswith(SENSOR_PREFIX) or name == "Label"
                else T.StringType(),
            )
            for name in header
        ]
    )


def read_labeled(
    spark: SparkSession, path: str, schema: T.StructType | None = None, strict: bool = False
) -> DataFrame:
    """Reads the CSV; a missing file gives an empty table.

    Without a schema only the header line is read to name the columns; the data is never
    scanned to infer types. ``strict`` fails on a cell that is not a number, otherwise the cell
    is NULL.
    """
    try:
        if schema is None:
            first = spark.read.text(path).first()
            header = [] if first is None else [c.strip().strip('"') for c in first[0].split(",")]
            schema = labeled_schema(header)
        mode = "FAILFAST" if strict else "PERMISSIVE"
        return spark.read.csv(path, header=True, schema=schema, mode=mode)
    except AnalysisException:
        return spark.createDataFrame([], schema or labeled_schema(["Label"]))


def labeled_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Label").isNotNull())
