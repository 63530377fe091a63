"""Reading messages: topic and file sources, decoding with a reason for rejects, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scale import with_global_rank
from ..schemas import struct

# Partitions a topic may have for offset-based reading ids to stay unique; more fail the job.
MAX_TOPIC_PARTITIONS = 4096
# A micro-batch numbers its readings within so many bits.
BATCH_BITS = 40
# Readings that one task numbers.
ROWS_PER_RANK_CELL = 125_000

# Values are read as text, so that one that is no number does not spoil its message.
_CHECKED = struct(
    machine_id=T.StringType(),
    timestamp=T.StringType(),
    readings=struct(readings=T.MapType(T.StringType(), T.StringType()), has_failure=T.BooleanType()),
    _corrupt_record=T.StringType(),
)


def topic_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """A topic from its earliest offset; progress lives in the query's checkpoint.

    Needs the Spark Kafka connector on the classpath.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("value", "partition", "offset")


def file_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Message files (one JSON message per line) as a stream with the column ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same message files as a batch."""
    return spark.read.text(path)


def decode(raw: DataFrame) -> DataFrame:
    """Decodes ``value`` into the reading columns plus ``reason``, NULL for accepted messages.

    A missing ``readings`` gives no values and a missing ``has_failure`` means false. A sensor value
    that is no number is left out and counted in ``n_bad_values``; its reading stays. All other
    columns of ``raw`` are kept.
    """
    kept = [name for name in raw.columns if name != "value"]
    # A generator keeps filters on the result above it, so that a message is parsed once.
    parsed = raw.withColumn("raw", F.col("value").cast("string")).select(
        *kept, "raw", F.inline(F.array(F.from_json("raw", _CHECKED, {"mode": "PERMISSIVE"})))
    )
    stamp = parse_timestamp(F.col("timestamp"))
    corrupt = F.col("_corrupt_record").isNotNull()
    reason = (
        F.when(F.col("raw").isNull() | (corrupt & F.try_parse_json("raw").isNull()), "not_json")
        .when(F.coalesce("machine_id", F.lit("")) == "", "missing_machine_id")
        .when(F.coalesce("timestamp", F.lit("")) == "", "missing_timestamp")
        .when(stamp.isNull(), "bad_timestamp")
        .when(corrupt, "bad_readings")
    )
    texts = F.coalesce(F.col("readings.readings"), F.create_map().cast("map<string,string>"))
    number = lambda v: v.try_cast("double")
    numeric = lambda _, v: v.isNull() | (number(v).isNotNull() & ~F.isnan(number(v)))
    usable = F.map_filter(texts, numeric)
    return parsed.select(
        *kept,
        "raw",
        "machine_id",
        stamp.alias("timestamp"),
        F.transform_values(usable, lambda _, v: number(v)).alias("values"),
        (F.size(texts) - F.size(usable)).alias("n_bad_values"),
        F.coalesce(F.col("readings.has_failure"), F.lit(False)).alias("has_failure"),
        reason.alias("reason"),
    )


def parse_timestamp(text: Column) -> Column:
    """An ISO-8601 timestamp, NULL where the text is not one; naive stamps are session time."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull()).drop("reason")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNotNull()).select("raw", "reason")


def rejected_by_reason(decoded: DataFrame) -> DataFrame:
    return rejected(decoded).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def with_reading_id(decoded: DataFrame, batch_id: int = 0) -> DataFrame:
    """Adds ``reading_id`` to accepted messages, unique and in order of arrival per machine.

    From topic partition and offset where there are any: a topic keyed by machine keeps a machine's
    messages in one partition. Else from the micro-batch and the place in it by time and text, so that a
    repeated micro-batch gives the same ids, equal messages differ, and ids of later ones are higher.
    """
    if {"partition", "offset"} <= set(decoded.columns):
        too_many = F.concat(F.lit("topic partition above the limit: "), F.col("partition"))
        part = F.when(F.col("partition") < MAX_TOPIC_PARTITIONS, F.col("partition")).otherwise(
            F.raise_error(too_many)
        )
        key = F.col("offset") * MAX_TOPIC_PARTITIONS + part
        return decoded.withColumn("reading_id", key.cast("bigint")).drop("partition", "offset")
    hashed = decoded.withColumn("_hash", F.xxhash64("raw"))
    ranked = with_global_rank(hashed, "timestamp", "_hash", rows_per_cell=ROWS_PER_RANK_CELL)
    first = batch_id << BATCH_BITS
    return ranked.withColumn("reading_id", F.col("rank") + first).drop("rank", "_hash")


def encode(readings: DataFrame, *also: str) -> DataFrame:
    """Readings as message text in ``value``, keyed by machine for the topic sink; keeps the columns ``also``."""
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(F.col("values").alias("readings"), "has_failure")
    message = F.struct("machine_id", stamp.alias("timestamp"), body.alias("readings"))
    return readings.select(F.col("machine_id").alias("key"), F.to_json(message).alias("value"), *also)


def send_to_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Writes encoded messages to a topic, keyed so that a machine's messages stay in order.

    Needs the Spark Kafka connector on the classpath.
    """
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
