import random
from dataclasses import replace

import pytest
from conftest import at
from pyspark.sql import functions as F

from millwatch.operators import drift as dr
from millwatch.operators import episodes as ep
from millwatch.operators import scoring as sc
from millwatch.operators.clustering import Model
from millwatch.plans import train as tr
from millwatch.schemas import DISTRIBUTIONS, DRIFT, PREDICTIONS
from millwatch.sources import messages, tables
from millwatch.streaming import ingest, scoring


def random_rows(n=240, seed=3):
    rng = random.Random(seed)
    rows, failing = [], {}
    for i in range(n):
        machine = "hot" if rng.random() < 0.6 else f"m{rng.randrange(4)}"
        if rng.random() < 0.3:
            failing[machine] = not failing.get(machine, False)
        rows.append((machine, i * 600, failing.get(machine, False)))
    return rows


def episode_rows(failures):
    columns = ["machine_id", "start_time", "end_time", "n_readings", "is_active"]
    return sorted(map(str, failures.select(columns).collect()))


@pytest.mark.parametrize("rows_per_cell", [5, 1_000_000])
def test_ingest_in_parts_equals_batch(make_readings, tmp_path, rows_per_cell):
    df = make_readings(random_rows())
    spark, root = df.sparkSession, str(tmp_path)
    for part in range(3):
        rows = df.filter((F.col("reading_id") / 80).cast("int") == part)
        batch = messages.encode(rows).select("value")
        ingest.ingest_batch(batch, part, root, rows_per_cell)
        if part == 1:  # a repeated micro-batch replaces itself
            ingest.ingest_batch(batch, part, root, rows_per_cell)
    linked = ep.link_episodes(df)
    assert episode_rows(ingest.current_failures(spark, root)) == episode_rows(ep.failures(linked))
    assert ingest.current_readings(spark, root).count() == df.count()
    machines = ingest.current_machines(spark, root, 2)
    assert sorted(map(str, machines.collect())) == sorted(map(str, ep.machines(df).collect()))


def test_late_messages_are_stored_and_broken_ones_kept_aside(make_readings, tmp_path):
    df = make_readings([("a", 10, 1), ("a", 20, 1), ("a", 15, 1), ("a", 5, 1), ("a", 12, 0), ("a", 30, 0), ("b", 1, 0)])
    spark, root = df.sparkSession, str(tmp_path)
    first = messages.encode(df.filter("reading_id < 2")).select("value")
    second = messages.encode(df.filter("reading_id >= 2")).select("value")
    junk = spark.createDataFrame([("junk",)], "value string")
    ingest.ingest_batch(first, 0, root)
    ingest.ingest_batch(second.unionAll(junk), 1, root)
    kept = tables.read_batches(spark, root + "/rejected", ingest.REJECTED)
    assert [r["reason"] for r in kept.collect()] == ["not_json"]
    found = ingest.current_readings(spark, root)
    late = {r["timestamp"]: r["failure_start"] for r in found.filter("late").collect()}
    assert late == {at(15): at(15), at(5): at(5), at(12): None}
    assert {r["failure_start"] for r in found.filter(F.col("timestamp") == at(20)).collect()} == {at(15)}
    assert found.count() == 7 and found.select("reading_id").distinct().count() == 7
    rows = ingest.current_failures(spark, root).orderBy("start_time").collect()
    ended = [(r["start_time"], r["end_time"], r["n_readings"]) for r in rows]
    assert ended == [(at(5), at(12), 2), (at(15), at(30), 2)]
    seen = {r["machine_id"]: r["first_seen"] for r in ingest.current_machines(spark, root, 1).collect()}
    assert seen == {"a": at(5), "b": at(1)}


def test_readings_of_one_instant_are_all_stored(make_readings, tmp_path):
    df = make_readings([(f"m{i}", 20, i % 2, {"Sensor 1": float(j)}) for i in range(40) for j in (0, 0, 1)])
    spark, root = df.sparkSession, str(tmp_path)
    for part in range(3):
        ingest.ingest_batch(messages.encode(df.filter(F.col("reading_id") % 3 == part)).select("value"), part, root)
    found = ingest.current_readings(spark, root)
    assert found.count() == 120 and found.filter("late").count() == 0
    assert found.select("reading_id").distinct().count() == 120
    assert found.filter("failure_id is not null").count() == 60


def test_a_bad_value_does_not_join_episodes(make_readings, tmp_path):
    df = make_readings([("a", 10, 1), ("a", 20, 0), ("a", 30, 1), ("a", 40, 0)])
    spark, root = df.sparkSession, str(tmp_path)
    sent = messages.encode(df).select(
        F.when(F.col("value").contains("00:00:20"), F.regexp_replace("value", '"Sensor 1":[^,}]*', '"Sensor 1":"n/a"'))
        .otherwise(F.col("value")).alias("value")
    )
    ingest.ingest_batch(sent, 0, root)
    assert ingest.current_readings(spark, root).count() == 4
    assert ingest.current_failures(spark, root).count() == 2


def test_parts_cover_all_rows_whatever_their_time(spark):
    from millwatch.plans.on_streams import PARTS, in_parts

    df = spark.sql("SELECT timestamp_seconds(x * 40000000L) AS timestamp, x FROM (SELECT explode(sequence(-9, 60)) AS x) UNION ALL SELECT NULL, 999")
    seen, runs = [], []
    in_parts(df, lambda part: seen.append({r["x"] for r in part.collect()}), lambda: runs.append(1))
    assert len(runs) == PARTS and sorted(x for s in seen for x in s) == [*range(-9, 61), 999]
    assert all(seen) and 999 in seen[0]


def test_a_lost_state_is_an_error(make_readings, tmp_path):
    batch = messages.encode(make_readings([("a", 1, 1)])).select("value")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        ingest.ingest_batch(batch, 3, str(tmp_path))


MODEL = Model(
    ["Sensor 1_mean", "Sensor 1_min"], [0.0] * 2, [1.0] * 2, [[0.0, 0.0], [100.0, 100.0]],
    run_id="r", version="1",
)


def test_scoring_in_parts_keeps_drift_across_batches(make_readings, tmp_path):
    rng = random.Random(5)
    rows = [("a", i * 900, 0, {"Sensor 1": rng.choice([0.0, 100.0])}) for i in range(120)]
    df = make_readings(rows)
    spark, root = df.sparkSession, str(tmp_path)
    for part in range(3):
        batch = df.filter((F.col("reading_id") / 40).cast("int") == part)
        scoring.score_batch(batch, part, root, MODEL, batch_size=10, window=4, threshold=0.001)
        scoring.score_batch(batch, part, root, MODEL, batch_size=10, window=4, threshold=0.001)
    found = tables.read_batches(spark, root + "/predictions", PREDICTIONS, by_date=True)
    assert found.count() == 120
    scored = sc.with_batch_no(sc.score(df, MODEL), 10)
    whole = dr.drift_series(dr.batch_distribution(scored, 2), 2, 4, 0.001)
    expected = {r["batch_no"]: r["drift_score"] for r in whole.filter("is_drift").collect()}
    events = tables.read_batches(spark, root + "/drift", DRIFT).collect()
    assert expected and {e["batch_no"]: e["drift_score"] for e in events} == pytest.approx(expected)
    state = tables.read(spark, tables.slot(root + "/drift_state", 2), DISTRIBUTIONS)
    assert sorted(r["batch_no"] for r in state.collect()) == [0, 1, 2, 3, 8, 9, 10, 11]


def test_a_new_model_can_start_its_own_reference(make_readings, tmp_path):
    df = make_readings([("a", i, 0, {"Sensor 1": 100.0 * (i % 2)}) for i in range(60)])
    spark, root = df.sparkSession, str(tmp_path)
    other = replace(MODEL, run_id="s", centroids=[*MODEL.centroids, [50.0, 50.0]])
    options = {"batch_size": 10, "window": 2, "threshold": 0.0001, "reset_on_model_change": True}
    scoring.score_batch(df.filter("reading_id < 30"), 0, root, MODEL, **options)
    scoring.score_batch(df.filter("reading_id >= 30"), 1, root, other, **options)
    found = tables.read_batches(spark, root + "/distributions", DISTRIBUTIONS).collect()
    assert sorted((r["run_id"], r["batch_no"], len(r["freqs"])) for r in found) == [
        ("r", 0, 2), ("r", 1, 2), ("r", 2, 2), ("s", 0, 3), ("s", 1, 3), ("s", 2, 3),
    ]


def test_models_of_different_size_share_a_window(make_readings, tmp_path):
    df = make_readings([("a", i, 0, {"Sensor 1": 100.0 * (i % 2)}) for i in range(80)])
    spark, root = df.sparkSession, str(tmp_path)
    larger = replace(MODEL, run_id="s", centroids=[*MODEL.centroids, [50.0, 50.0]])
    parts = [(larger, "reading_id < 40"), (MODEL, "reading_id >= 40 and reading_id < 60")]
    parts.append((larger, "reading_id >= 60"))
    for part, (model, rows) in enumerate(parts):
        scoring.score_batch(df.filter(rows), part, root, model, batch_size=10, window=2)
    found = tables.read_batches(spark, root + "/distributions", DISTRIBUTIONS)
    assert [r["batch_no"] for r in found.orderBy("batch_no").collect()] == list(range(8))
    assert tables.read_batches(spark, root + "/drift", DRIFT).count() == 0


def test_version_signals_are_picked_up_once(spark, make_readings, tmp_path):
    root = str(tmp_path)
    rows = [(f"m{i}", t, 1 - t, {"Sensor 1": float(i)}) for i in range(4) for t in (0, 1)]
    done = tr.train(ep.link_episodes(make_readings(rows)), F.lit(at(60)), run_id="r1", k=2)
    assert not tr.pick_up_versions(spark, root)
    tr.publish(spark, root, done, F.lit(at(1)))
    tr.publish(spark, root, done, F.lit(at(2)))
    assert tr.pick_up_versions(spark, root) and not tr.pick_up_versions(spark, root)
    tr.publish(spark, root, done, F.lit(at(3)))
    assert [r["id"] for r in tr.current_versions(spark, root).filter("not is_processed").collect()] == [3]


def test_two_publishers_get_ids_of_their_own(spark, make_readings, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = [(f"m{i}", t, 1 - t, {"Sensor 1": float(i)}) for i in range(4) for t in (0, 1)]
    done = tr.train(ep.link_episodes(make_readings(rows)), F.lit(at(60)), run_id="r1", k=2)
    real, raced = tr.Commits.create, []

    def late(self, number, content):
        if not raced:  # another publisher is faster, from claim to signal
            raced.append(number)
            tr.publish(spark, root, done, F.lit(at(1)))
        real(self, number, content)

    monkeypatch.setattr(tr.Commits, "create", late)
    tr.publish(spark, root, done, F.lit(at(2)))
    clusters = tables.read(spark, root + "/clusters", tr.CLUSTERS)
    assert sorted(r["id"] for r in clusters.collect()) == [1, 2] and raced == [0]
    assert sorted(r["id"] for r in tr.current_versions(spark, root).collect()) == [1, 2]
    active = tr.registry.switch_model(clusters).filter("is_active").collect()
    assert [(r["id"], r["created_at"]) for r in active] == [(2, at(2))]


def test_readings_scored_before_are_not_scored_again(make_readings, tmp_path):
    df = make_readings([("a", i, 0) for i in range(6)])
    root = str(tmp_path)
    scoring.score_batch(df.filter("reading_id < 4"), 0, root, MODEL)
    scoring.score_batch(df, 1, root, MODEL)
    scoring.score_batch(df, 2, root, MODEL)
    found = tables.read_batches(df.sparkSession, root + "/predictions", PREDICTIONS, by_date=True)
    assert sorted((r["reading_id"], r["batch_id"]) for r in found.collect()) == [
        (0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 1),
    ]


def test_the_scratch_folder_is_the_configured_one(spark, monkeypatch):
    from millwatch import session

    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.single_process("local") and session.single_process("local[8]")
    assert not session.single_process("local-cluster[2,1,1024]")
    assert not session.single_process("spark://host:7077")

    class Bare:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default: default)

        class sparkContext:  # noqa: N801
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(Bare)


def test_work_per_trigger_does_not_grow_with_past_batches(make_readings, tmp_path, monkeypatch):
    root, seen = str(tmp_path), []
    real = tables.read_days

    def counted(spark, path, schema, days, batch_id=None):
        df = real(spark, path, schema, days, batch_id)
        seen.append(len(df.inputFiles()))
        return df

    monkeypatch.setattr(tables, "read_days", counted)
    monkeypatch.setattr(tables, "read_batches", None)
    for part in range(5):
        df = make_readings([("a", part * 86400 + i, 0) for i in range(3)])
        scoring.score_batch(df.withColumn("reading_id", F.col("reading_id") + 10 * part), part, root, MODEL)
    assert seen[0::2] == [0] * 5 and len(set(seen[1::2])) == 1


def test_an_empty_registry_is_waited_for(make_readings, tmp_path, monkeypatch):
    df = make_readings([("a", i, 0) for i in range(3)])
    spark, root = df.sparkSession, str(tmp_path)
    df.withColumns({"closes": F.lit(None).cast("bigint"), "failure_id": F.lit(None).cast("bigint")}).write.parquet(root + "/in")
    models = [None, None, MODEL]
    monkeypatch.setattr(scoring, "load_active", lambda *_: models.pop(0))
    monkeypatch.setattr(scoring, "pick_up_versions", lambda *_: False)
    stream = spark.readStream.schema(spark.read.parquet(root + "/in").schema).parquet(root + "/in")
    scoring.start_scoring(stream, root, root + "/checkpoint", poll_seconds=0.01).awaitTermination()
    assert tables.read_batches(spark, root + "/predictions", PREDICTIONS, by_date=True).count() == 3
    assert not models


def test_waiting_for_a_model_ends(make_readings, tmp_path, monkeypatch):
    df = make_readings([("a", 0, 0)])
    spark, root = df.sparkSession, str(tmp_path)
    df.withColumns({"closes": F.lit(None).cast("bigint"), "failure_id": F.lit(None).cast("bigint")}).write.parquet(root + "/in")
    monkeypatch.setattr(scoring, "load_active", lambda *_: None)
    monkeypatch.setattr(scoring, "pick_up_versions", lambda *_: False)
    stream = spark.readStream.schema(spark.read.parquet(root + "/in").schema).parquet(root + "/in")
    query = scoring.start_scoring(stream, root, root + "/checkpoint", poll_seconds=0.01, wait_seconds=0.05)
    with pytest.raises(Exception, match="no active model"):
        query.awaitTermination()
