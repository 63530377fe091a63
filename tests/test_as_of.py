from dataclasses import replace

import pytest
from conftest import at
from pyspark.sql import functions as F

from millwatch.operators import episodes as ep
from millwatch.operators import scoring as sc
from millwatch.operators.clustering import Model
from millwatch.plans import train as tr

NAMES = ["Sensor 1_mean"]


def model(version, *centres):
    return Model(NAMES, [0.0], [1.0], [[c] for c in centres], version=version)


def test_each_reading_is_scored_by_the_model_of_its_time(make_readings):
    df = make_readings([("a", s, 0, {"Sensor 1": 9.0}) for s in (0, 10, 19, 20, 20, 35)])
    df = df.unionByName(df.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp")))
    df = df.unionByName(make_readings([("b", 40, 0, {"Sensor 2": 1.0})]))
    history = [(at(20), model("2", 9.0, 0.0)), (at(10), model("1", 0.0, 9.0)), (at(20), model("3", 9.0, 0.0, 5.0))]
    got = sc.score_as_of(df, history)
    assert got.columns == [*df.columns, "cluster_id", "model_version"]
    # a sensor without a value counts as 0, the centre of cluster 1
    rows = [(r["timestamp"], r["cluster_id"], r["model_version"]) for r in got.collect()]
    assert len(rows) == 8
    assert sorted(r for r in rows if r[0] is not None) == [
        (at(0), None, None), (at(10), 1, "1"), (at(19), 1, "1"), (at(20), 0, "3"), (at(20), 0, "3"), (at(35), 0, "3"),
        (at(40), 1, "3"),
    ]
    assert (None, None, None) in rows
    plain = sc.score_as_of(make_readings([("a", 0, 0)]), history)
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()


def test_no_model_and_too_many(make_readings):
    df = make_readings([("a", 0, 0)])
    assert [(r["cluster_id"], r["model_version"]) for r in sc.score_as_of(df, []).collect()] == [(None, None)]
    assert sc.score_as_of(df.limit(0), [(at(0), model("1", 1.0))]).count() == 0
    with pytest.raises(ValueError, match="2 models"):
        sc.score_as_of(df, [(at(0), model("1", 1.0))] * 2, max_history=1)


def test_history_of_the_registry(spark, make_readings, tmp_path):
    root = str(tmp_path)
    rows = [(f"m{i}", t, 1 - t, {"Sensor 1": float(i)}) for i in range(4) for t in (0, 1)]
    done = tr.train(ep.link_episodes(make_readings(rows)), F.lit(at(60)), run_id="r1", k=2)
    for n, second in enumerate((100, 300, 200), 1):
        again = replace(done, model=replace(done.model, run_id=f"r{n}"))
        tr.publish(spark, root, again, F.lit(at(second)))
    found = tr.load_history(spark, root)
    # the third, with the highest id, was made before the second and stays the active one
    assert [(t, m.run_id) for t, m in found] == [(at(100), "r1"), (at(200), "r3")]
    assert [m.run_id for _, m in tr.load_history(spark, root, limit=1)] == ["r3"]
    assert tr.load_history(spark, str(tmp_path / "empty")) == []
