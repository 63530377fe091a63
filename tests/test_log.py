"""The partitioned log: offsets, restarts, admission, repeated and concurrent writers."""

import pytest
from pyspark.sql import functions as F

from millwatch.sources import log
from millwatch.sources.commits import Commits, Taken


def sent(spark, first, n, hot=2):
    """``n`` messages, half of them with one key."""
    rows = spark.range(first, first + n).select(
        F.when(F.col("id") % hot == 0, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 7)).alias("key"),
        F.col("id").cast("string").alias("value"), F.timestamp_seconds("id").alias("timestamp"),
        F.col("id").alias("reading_id"),
    )
    return rows


def check(rows, n):
    """Offsets have no gap, follow the order of sending, and nothing is there twice."""
    assert sorted(int(r.value) for r in rows) == list(range(n))
    parts = {}
    for r in rows:
        parts.setdefault(r.partition, []).append((r.offset, int(r.value)))
    for found in parts.values():
        found.sort()
        assert [o for o, _ in found] == list(range(len(found)))
        assert [v for _, v in found] == sorted(v for _, v in found)


def run(spark, root, out, **trigger):
    limits = {"limit": 10, "progress": f"{out}/progress"} if "processingTime" in trigger else {}
    query = (
        log.log_stream(spark, root, **limits)
        .writeStream.foreachBatch(
            lambda b, n: b.withColumn("nth", F.lit(n)).write.mode("overwrite").parquet(f"{out}/data/batch={n}")
        )
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(**trigger)
        .start()
    )
    if limits:
        query.processAllAvailable()
        query.stop()
    else:
        query.awaitTermination()
    return spark.read.parquet(f"{out}/data").collect()


def test_restart_resumes_at_the_offsets(spark, tmp_path):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    log.append(sent(spark, 0, 60), root, 3, segment_rows=16)
    check(run(spark, root, out, availableNow=True), 60)
    log.append(sent(spark, 60, 30), root, 3, segment_rows=16)
    log.append(sent(spark, 90, 5), root, 3, segment_rows=16)
    rows = run(spark, root, out, availableNow=True)
    check(rows, 95)
    assert {int(r.value) for r in rows if r.nth == 0} == set(range(60))
    check(log.read_log(spark, root).collect(), 95)


def test_limit_holds_across_a_restart(spark, tmp_path):
    root, out = str(tmp_path / "log"), str(tmp_path / "out")
    log.append(sent(spark, 0, 60), root, 3, segment_rows=16)
    check(run(spark, root, out, processingTime="0 seconds"), 60)
    log.append(sent(spark, 60, 40), root, 3, segment_rows=16)
    rows = run(spark, root, out, processingTime="0 seconds")
    check(rows, 100)
    sizes = {}
    for r in rows:
        sizes[r.nth, r.partition] = sizes.get((r.nth, r.partition), 0) + 1
    assert max(sizes.values()) == 10
    with pytest.raises(ValueError, match="progress"):
        log.log_stream(spark, root, limit=5)


def test_writers(spark, tmp_path):
    root = str(tmp_path / "log")
    assert log.append(sent(spark, 0, 10), root, 2, token="a") == 0
    assert log.append(sent(spark, 0, 10), root, 2, token="a") == 0
    with pytest.raises(ValueError, match="2 partitions"):
        log.append(sent(spark, 10, 5), root, 3)
    Commits(spark, f"{root}/_commits")._write(f"{1:020d}.claim", b"")
    with pytest.raises(Taken):
        log.append(sent(spark, 10, 5), root, 2)
    check(log.read_log(spark, root).collect(), 10)
    log.recover(spark, root)
    assert log.append(sent(spark, 10, 5), root, 2) == 1
    check(log.read_log(spark, root).collect(), 15)
