"""Streaming queries: the tables arrive in parts, each run resumes from the checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.episodes import link_episodes
from ..schemas import DRIFT, PREDICTIONS, READINGS
from ..session import scratch_path
from ..sources import log, messages, tables
from ..streaming import delivery, ingest, rates, scoring
from . import driver_views as views
from . import train as tr
from .catalog import query
from .on_drift import PREDICTED_SQL, events_long, events_sql, predicted, series_sql
from .on_ingest import as_of, ntz
from .on_models import training
from .on_scoring import SCORED_SQL
from .sql_parts import EPISODES_SQL, MODEL_K

# Parts in which the data arrive, equal spans of their time.
PARTS = 4
DRIFT_SPAN = 10
DRIFT_LIMIT = 0.0005
DELAY_MINUTES = 10
_MICROS = "epoch_us(\"timestamp\")"


def in_parts(
    df: DataFrame, write: Callable[[DataFrame], None], run: Callable[[], None], parts: int = PARTS
) -> None:
    """Writes all rows in time order, part by part, and runs the stream after each part.

    The bounds come from the data; rows without a time belong to the first part.
    """
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    low, high = df.agg(F.min(micros), F.max(micros)).first()
    width = ((high or 0) - (low or 0)) // parts + 1
    of = F.coalesce(F.floor((micros - F.lit(low or 0)) / F.lit(width)), F.lit(0))
    for part in range(parts):
        write(df.filter(of == part))
        run()


def ingested(spark: SparkSession, sf_dir: str) -> str:
    """Events sent as messages and ingested in parts; gives the folder of the tables."""
    root = scratch_path(spark, "ingest")

    def send(part: DataFrame) -> None:
        messages.encode(part).select("value").write.mode("append").text(f"{root}/inbox")

    def run() -> None:
        raw = messages.file_stream(spark, f"{root}/inbox")
        ingest.start_ingest(raw, root, f"{root}/checkpoint").awaitTermination()

    in_parts(views.readings(spark, sf_dir), send, run)
    return root


@query(
    f"""WITH {EPISODES_SQL}
SELECT machine_id, start_time, end_time, is_active, n_readings FROM failures"""
)
def stream_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ingest.current_failures(spark, ingested(spark, sf_dir))
    return found.select(
        "machine_id", ntz("start_time"), ntz("end_time"), "is_active", "n_readings"
    )


@query(
    f"""WITH {EPISODES_SQL}
SELECT r.machine_id, r."timestamp", r.has_failure, m.start_time AS failure_start
FROM readings r LEFT JOIN members m ON m.reading_id = r.reading_id"""
)
def stream_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ingest.current_readings(spark, ingested(spark, sf_dir))
    return found.select("machine_id", ntz("timestamp"), "has_failure", ntz("failure_start"))


@query(
    """SELECT 'm' || CAST(user_id AS VARCHAR) AS machine_id, min(ts) AS first_seen, max(ts) AS last_seen
FROM events GROUP BY user_id"""
)
def stream_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ingest.current_machines(spark, ingested(spark, sf_dir), PARTS - 1)
    return found.select("machine_id", ntz("first_seen"), ntz("last_seen"))


@query(
    """SELECT 'm' || CAST(user_id AS VARCHAR) AS machine_id, CAST(count(*) AS BIGINT) AS n_readings,
       CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS n_failing,
       min(ts) AS first_seen, max(ts) AS last_seen
FROM events GROUP BY user_id"""
)
def stream_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that arrive in no order over several micro-batches: every reading is there."""
    root = scratch_path(spark, "any-order")
    rows = views.readings(spark, sf_dir)
    for part in range(PARTS):
        mixed = rows.filter(F.pmod(F.xxhash64("reading_id"), F.lit(PARTS)) == part)
        messages.encode(mixed).select("value").write.mode("append").text(f"{root}/inbox")
        raw = messages.file_stream(spark, f"{root}/inbox")
        ingest.start_ingest(raw, root, f"{root}/checkpoint").awaitTermination()
    found = ingest.current_readings(spark, root).groupBy("machine_id").agg(
        F.count(F.lit(1)).alias("n_readings"), F.count_if("has_failure").alias("n_failing")
    )
    seen = ingest.current_machines(spark, root, PARTS - 1)
    return found.join(seen, "machine_id").select(
        "machine_id", "n_readings", "n_failing", ntz("first_seen"), ntz("last_seen")
    )


LOG_PARTITIONS = 3


@query(
    f"""WITH {EPISODES_SQL}
SELECT r.machine_id, r."timestamp", r.has_failure, m.start_time AS failure_start
FROM readings r LEFT JOIN members m ON m.reading_id = r.reading_id"""
)
def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings sent to a partitioned log in parts; their ids come from partition and offset."""
    root = scratch_path(spark, "log")

    def send(part: DataFrame) -> None:
        log.append(messages.encode(part, "timestamp", "reading_id"), f"{root}/log", LOG_PARTITIONS)

    def run() -> None:
        raw = log.log_stream(spark, f"{root}/log")
        ingest.start_ingest(raw, root, f"{root}/checkpoint").awaitTermination()

    in_parts(views.readings(spark, sf_dir), send, run)
    found = ingest.current_readings(spark, root)
    return found.select("machine_id", ntz("timestamp"), "has_failure", ntz("failure_start"))


MANY = 12


@query(
    f"""WITH {EPISODES_SQL}
SELECT machine_id, start_time, end_time, is_active, n_readings FROM failures"""
)
def stream_repaired_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of messages that arrive in no order, repaired by every late one."""
    root = scratch_path(spark, "repaired")
    rows = views.readings(spark, sf_dir)
    for part in range(PARTS):
        mixed = rows.filter(F.pmod(F.xxhash64("reading_id"), F.lit(PARTS)) == part)
        messages.encode(mixed).select("value").write.mode("append").text(f"{root}/inbox")
        raw = messages.file_stream(spark, f"{root}/inbox")
        ingest.start_ingest(raw, root, f"{root}/checkpoint").awaitTermination()
    found = ingest.current_failures(spark, root)
    return found.select("machine_id", ntz("start_time"), ntz("end_time"), "is_active", "n_readings")


@query(
    f"""WITH {EPISODES_SQL}
SELECT machine_id, start_time, end_time, is_active, n_readings FROM failures"""
)
def stream_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of twelve micro-batches in time order, compacted after every fourth."""
    root = scratch_path(spark, "compacted")

    def send(part: DataFrame) -> None:
        messages.encode(part).select("value").write.mode("append").text(f"{root}/inbox")

    def run() -> None:
        raw = messages.file_stream(spark, f"{root}/inbox")
        ingest.start_ingest(raw, root, f"{root}/checkpoint", compact_every=4).awaitTermination()

    in_parts(views.readings(spark, sf_dir), send, run, MANY)
    found = ingest.current_failures(spark, root)
    return found.select("machine_id", ntz("start_time"), ntz("end_time"), "is_active", "n_readings")


def scored_stream(spark: SparkSession, sf_dir: str) -> str:
    """Linked readings arriving in parts, scored by a published model."""
    root = scratch_path(spark, "scoring")
    # linked once, for training and for scoring
    linked = link_episodes(views.readings(spark, sf_dir))
    rows = tables.materialise(tables.conform(linked, ingest.LINKED), "linked")
    tr.publish(spark, root, training(spark, sf_dir, linked=rows), as_of())

    def send(part: DataFrame) -> None:
        part.write.mode("append").parquet(f"{root}/readings")

    def run() -> None:
        stream = spark.readStream.schema(ingest.LINKED).parquet(f"{root}/readings")
        scoring.start_scoring(
            stream, root, f"{root}/checkpoint", window=DRIFT_SPAN, threshold=DRIFT_LIMIT
        ).awaitTermination()

    in_parts(rows, send, run)
    return root


@query(
    f"""WITH {SCORED_SQL}
SELECT id AS reading_id, CAST(cluster_id AS INT) AS cluster_id, '1' AS model_version FROM scored"""
)
def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scored_stream(spark, sf_dir)
    found = tables.read_batches(spark, f"{root}/predictions", PREDICTIONS, by_date=True)
    return found.select("reading_id", "cluster_id", "model_version")


@query(
    f"""WITH {SCORED_SQL},
parts AS (
  SELECT reading_id, "timestamp", ({_MICROS} - lo) // ((hi - lo) // {PARTS} + 1) AS part
  FROM readings, (SELECT min({_MICROS}) AS lo, max({_MICROS}) AS hi FROM readings)
  WHERE NOT has_failure),
batches AS (
  SELECT reading_id, part,
         (row_number() OVER (PARTITION BY part ORDER BY "timestamp", reading_id) - 1) // 100 AS nth
  FROM parts),
predicted AS (
  SELECT dense_rank() OVER (ORDER BY part, nth) - 1 AS batch_no, cluster_id
  FROM batches JOIN scored ON scored.id = batches.reading_id),
{series_sql(MODEL_K, DRIFT_SPAN)}
{events_sql(DRIFT_LIMIT)}"""
)
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scored_stream(spark, sf_dir)
    return events_long(tables.read_batches(spark, f"{root}/drift", DRIFT).drop("batch_id"))


@query(
    f"""WITH {PREDICTED_SQL}
SELECT date_trunc('minute', ts) AS minute, CAST(cluster_id AS INT) AS cluster_id, CAST(count(*) AS BIGINT) AS per_minute
FROM predicted GROUP BY ALL"""
)
def stream_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All minutes, the open ones too: counts only grow, so the highest one of a minute holds."""
    root = scratch_path(spark, "rates")
    rows = predicted(spark, sf_dir)

    def send(part: DataFrame) -> None:
        part.write.mode("append").parquet(f"{root}/inbox")

    def run() -> None:
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/inbox")
        counted = rates.stream_rates(stream, keys=["cluster_id"], delay=f"{DELAY_MINUTES} minutes")
        (
            counted.writeStream.outputMode("update")
            .foreachBatch(
                lambda part, n: part.write.mode("overwrite").parquet(f"{root}/rates/batch_id={n}")
            )
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    in_parts(rows, send, run)
    found = spark.read.parquet(f"{root}/rates").groupBy("minute", "cluster_id")
    return found.agg(F.max("per_minute").alias("per_minute")).select(
        ntz("minute"), "cluster_id", "per_minute"
    )


@query(
    """SELECT machine_id, "timestamp", has_failure FROM (
  SELECT DISTINCT 'm' || CAST(user_id AS VARCHAR) AS machine_id, ts AS "timestamp",
         event_type = 'error' AS has_failure, value, json_extract(props, '$.k') AS k FROM events)"""
)
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered twice, kept once."""
    root = scratch_path(spark, "dedupe")

    def send(part: DataFrame) -> None:
        sent = messages.encode(part).select("value")
        sent.unionAll(sent).write.mode("append").text(f"{root}/inbox")

    def run() -> None:
        decoded = messages.decode(messages.file_stream(spark, f"{root}/inbox"))
        kept = rates.drop_repeats(messages.accepted(decoded)).drop("raw", "n_bad_values")
        (
            kept.writeStream.format("parquet")
            .option("path", f"{root}/readings")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    in_parts(views.readings(spark, sf_dir), send, run)
    found = spark.read.parquet(f"{root}/readings")
    return found.select("machine_id", ntz("timestamp"), "has_failure")


@query(
    f"""WITH ends AS (SELECT min(epoch_us(ts)) AS low, (max(epoch_us(ts)) - min(epoch_us(ts))) // {PARTS} + 1 AS width FROM events),
sent AS (
  SELECT 'm' || CAST(user_id AS VARCHAR) AS machine_id, ts, (epoch_us(ts) - low) // width AS part, count(*) AS c
  FROM events, ends
  GROUP BY user_id, ts, part, event_type = 'error', value, json_extract(props, '$.k')),
latest AS (SELECT part, max(max(ts)) OVER (ORDER BY part) - INTERVAL {DELAY_MINUTES} MINUTE AS behind FROM sent GROUP BY part),
counted AS (
  SELECT machine_id, c, CASE WHEN part = {PARTS - 1} THEN 0 ELSE c END AS again, ts < behind AS is_late
  FROM sent JOIN latest USING (part))
SELECT machine_id, count(*) AS kept,
       CAST(sum(2 * c - 1 + CASE WHEN is_late THEN 0 ELSE again END) AS BIGINT) AS repeats,
       CAST(sum(CASE WHEN is_late THEN again ELSE 0 END) AS BIGINT) AS late
FROM counted GROUP BY machine_id"""
)
def stream_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message sent twice, and once more with the part after its own: kept, repeated and late rows."""
    root = scratch_path(spark, "delivery")
    before: list[DataFrame] = []

    def send(part: DataFrame) -> None:
        sent = messages.encode(part).select("value")
        for rows in (sent, sent, *before):
            rows.write.mode("append").text(f"{root}/inbox")
        before[:] = [sent]

    def step(batch: DataFrame, batch_id: int) -> None:
        valid = messages.accepted(messages.decode(batch))
        kept = delivery.keep_once(valid, batch_id, root, DELAY_MINUTES)
        tables.write_batch(kept, f"{root}/readings", batch_id, READINGS, by_date="timestamp")

    def run() -> None:
        (
            messages.file_stream(spark, f"{root}/inbox")
            .writeStream.foreachBatch(step)
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    in_parts(views.readings(spark, sf_dir), send, run)
    return delivery.totals(spark, root)
