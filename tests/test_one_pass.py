"""What a micro-batch reads several times is worked out once."""

from pyspark.sql import functions as F

from millwatch.plans import on_models, on_streams
from millwatch.sources import messages, tables
from millwatch.streaming import delivery, ingest, repair, scoring


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def sent(make_readings):
    rows = make_readings([("a", 0, False), ("a", 1, True), ("b", 2, False)])
    return messages.encode(rows).select("value")


def test_readings_of_a_batch_are_numbered_once(make_readings, tmp_path, monkeypatch):
    seen, link = [], ingest.link_episodes
    monkeypatch.setattr(ingest, "link_episodes", lambda rows, *a: seen.append(plan(rows)) or link(rows, *a))
    ingest.ingest_batch(sent(make_readings), 0, str(tmp_path))
    assert len(seen) == 1 and "row_number" not in seen[0] and "from_json" not in seen[0]


def test_a_region_and_the_state_after_it_are_worked_out_once(make_readings, tmp_path, monkeypatch):
    regions, carried = [], []
    relinked, link = repair.relinked, ingest.link_episodes
    monkeypatch.setattr(repair, "relinked", lambda late, found, n: regions.append(found) or relinked(late, found, n))
    monkeypatch.setattr(ingest, "link_episodes", lambda rows, state, n: carried.append(plan(state)) or link(rows, state, n))
    rows = make_readings([("a", 0, True), ("a", 4, True), ("a", 9, False), ("a", 2, False), ("a", 12, True)])
    for part in (F.col("reading_id") < 3, F.col("reading_id") >= 3):
        batch = messages.encode(rows.filter(part)).select("value")
        ingest.ingest_batch(batch, len(carried), str(tmp_path))
    (found,) = regions
    assert "values" not in found.rows.columns and "reading_id" in found.rows.columns
    assert "Aggregate" not in plan(found.rows) and "max_by" not in carried[1]
    stored = ingest.current_readings(found.rows.sparkSession, str(tmp_path)).orderBy("timestamp").collect()
    assert [r["values"] for r in stored] == [{"Sensor 1": float(i)} for i in (0, 3, 1, 2, 4)]
    episodes = ingest.current_failures(found.rows.sparkSession, str(tmp_path)).collect()
    assert sorted(r["n_readings"] for r in episodes) == [1, 1, 1]


def test_messages_are_decoded_once_for_delivery(make_readings, tmp_path, monkeypatch):
    seen, days = [], tables.days_of
    monkeypatch.setattr(tables, "days_of", lambda df: seen.append(plan(df)) or days(df))
    rows = sent(make_readings)
    valid = messages.accepted(messages.decode(rows.unionAll(rows)))
    kept = delivery.keep_once(valid, 0, str(tmp_path), 10)
    assert kept.count() == 3 and len(seen) == 1 and "from_json" not in seen[0]


def test_many_cells_number_as_one(spark, monkeypatch):
    rows = spark.range(3000).select(
        F.timestamp_seconds(F.col("id") % 700).alias("timestamp"), F.concat(F.lit("r"), "id").alias("raw")
    )
    want = {r["raw"]: r["reading_id"] for r in messages.with_reading_id(rows, 2).collect()}
    monkeypatch.setattr(messages, "ROWS_PER_RANK_CELL", 50)
    assert {r["raw"]: r["reading_id"] for r in messages.with_reading_id(rows, 2).collect()} == want


def test_scored_readings_are_linked_once_and_numbered_in_small_cells(spark, monkeypatch):
    links, cells = [], []
    link, train, number = on_streams.link_episodes, on_models.linked_failing, scoring.sc.with_batch_no
    monkeypatch.setattr(on_streams, "link_episodes", lambda *a: links.append("stream") or link(*a))
    monkeypatch.setattr(on_models, "linked_failing", lambda *a: links.append("training") or train(*a))
    monkeypatch.setattr(scoring.sc, "with_batch_no", lambda rows, *a: cells.append(a[1:]) or number(rows, *a))
    on_streams.scored_stream(spark, "/root/testdata/sf0.001")
    assert links == ["stream"]
    assert len(cells) == on_streams.PARTS and set(cells) == {(125_000,)}


def test_batches_are_the_same_in_cells_of_any_size(spark):
    rows = spark.range(2000).select(
        F.col("id").alias("reading_id"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(300))).alias("timestamp")
    )
    want = {tuple(r) for r in scoring.sc.with_batch_no(rows, 100).select("reading_id", "batch_no").collect()}
    assert {tuple(r) for r in scoring.sc.with_batch_no(rows, 100, 60).select("reading_id", "batch_no").collect()} == want
