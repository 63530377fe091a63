import json

import pytest
from conftest import at

from millwatch.operators import profiles as pf
from millwatch.sources import labeled, messages

GOOD = {
    "machine_id": "a",
    "timestamp": "2024-01-01T00:00:01.500000",
    "readings": {"readings": {"Sensor 1": 1.5}, "has_failure": True},
}


def text(**changes):
    return json.dumps({**GOOD, **changes})


def without(name):
    return json.dumps({k: v for k, v in GOOD.items() if k != name})


@pytest.mark.parametrize(
    ("message", "reason"),
    [
        (text(), None),
        ("not json", "not_json"),
        ("{\"machine_id\": \"a\"", "not_json"),
        (without("machine_id"), "missing_machine_id"),
        (text(machine_id=""), "missing_machine_id"),
        (without("timestamp"), "missing_timestamp"),
        (text(timestamp=""), "missing_timestamp"),
        (text(timestamp="soon"), "bad_timestamp"),
        (text(timestamp="2024-13-01T00:00:00"), "bad_timestamp"),
        (without("readings"), None),
        (text(readings={}), None),
        (text(readings={"readings": {"Sensor 1": "n/a"}, "has_failure": False}), None),
        (text(readings={"readings": "none", "has_failure": False}), "bad_readings"),
        (text(readings={"readings": {"Sensor 1": 1}, "has_failure": "maybe"}), "bad_readings"),
    ],
)
def test_reasons(spark, message, reason):
    row = messages.decode(spark.createDataFrame([(message,)], "value string")).first()
    assert row["reason"] == reason


def test_defaults_and_values(spark):
    raw = spark.createDataFrame([(text(),), (without("readings"),)], "value string")
    good, bare = messages.accepted(messages.decode(raw)).collect()
    assert good["values"] == {"Sensor 1": 1.5} and good["has_failure"] is True
    assert good["timestamp"] == at(1.5)
    assert bare["values"] == {} and bare["has_failure"] is False


def test_a_bad_value_leaves_only_itself_out(spark):
    values = {"a": "n/a", "b": 2, "c": "3.5", "d": [1], "e": None, "f": True, "g": "NaN"}
    raw = spark.createDataFrame([(text(readings={"readings": values}),)], "value string")
    row = messages.accepted(messages.decode(raw)).first()
    assert row["values"] == {"b": 2.0, "c": 3.5, "e": None} and row["n_bad_values"] == 4


def test_rejects_are_counted_and_kept(spark):
    raw = spark.createDataFrame([("x",), ("y",), (text(machine_id=""),)], "value string")
    decoded = messages.decode(raw)
    counts = {r["reason"]: r["n"] for r in messages.rejected_by_reason(decoded).collect()}
    assert counts == {"not_json": 2, "missing_machine_id": 1}
    assert {r["raw"] for r in messages.rejected(decoded).collect()} >= {"x", "y"}


def test_round_trip(make_readings):
    df = make_readings([("a", 1, 1, {"Sensor 1": 0.1, "Other": 2.0}), ("b", 2, 0, {})])
    back = messages.accepted(messages.decode(messages.encode(df).select("value")))
    key = ["machine_id", "timestamp", "values", "has_failure"]
    assert sorted(map(str, back.select(key).collect())) == sorted(map(str, df.select(key).collect()))


def test_reading_ids_follow_offsets(spark):
    raw = spark.createDataFrame([(text(), 3, 7), (text(), 1, 8)], "value string, partition int, offset bigint")
    ids = [r["reading_id"] for r in messages.with_reading_id(messages.decode(raw)).collect()]
    assert ids == [7 * 4096 + 3, 8 * 4096 + 1]


def test_labeled_csv(spark, tmp_path):
    path = tmp_path / "labeled.csv"
    path.write_text("id,Sensor 1,Sensor 10,Label\nx,1,2,\ny,3,4,1\nz,5,4,1\nw,oops,4,2\n")
    df = labeled.read_labeled(spark, str(path))
    assert df.dtypes == [
        ("id", "string"), ("Sensor 1", "double"), ("Sensor 10", "double"), ("Label", "double"),
    ]
    rows = {(r["label"], r["sensor"]): (r["mean"], r["std"]) for r in pf.label_pattern(df).collect()}
    assert rows[(1.0, "Sensor 1")] == (4.0, pytest.approx(2**0.5))
    assert rows[(1.0, "Sensor 10")] == (4.0, 0.0)
    assert rows[(2.0, "Sensor 1")] == (0.0, 0.0)
    with pytest.raises(Exception, match="oops"):
        labeled.read_labeled(spark, str(path), strict=True).collect()
    assert labeled.read_labeled(spark, str(tmp_path / "absent.csv")).count() == 0


def test_default_profiles_only_without_data(spark):
    full = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0)], "`Sensor 1` double, Label double")
    default = pf.default_sensor_profile(spark, 2)
    assert pf.or_default(pf.sensor_profile(full), default).first()["std"] == pytest.approx(2**0.5)
    kept = pf.or_default(pf.sensor_profile(full.limit(0)), default).collect()
    assert [r["sensor"] for r in kept] == ["Sensor 0", "Sensor 1"]
    assert pf.default_label_pattern(spark).count() == 60


def test_clamp_raises_a_positive_floor(spark):
    df = spark.createDataFrame([("s", 1.0), ("s", 9.0), ("s", 4.0)], "sensor string, value double")
    profile = spark.createDataFrame([("s", 2.0, 5.0)], "sensor string, min double, max double")
    assert sorted(r["value"] for r in pf.clamp_readings(df, profile).collect()) == [2.4, 4.0, 6.0]
