import random

import pytest
from conftest import at

from millwatch.functions.scale import ordered_cells, with_global_rank
from millwatch.operators import episodes as ep


def found(df):
    return sorted(
        (r["machine_id"], r["start_time"], r["end_time"], r["n_readings"], r["is_active"])
        for r in ep.failures(ep.link_episodes(df)).collect()
    )


def replay(rows):
    """Brute force: one pass over the ordered readings with the open episode per machine."""
    open_now, links, ends = {}, {}, {}
    for row in sorted(rows, key=lambda r: (r["machine_id"], r["timestamp"], r["reading_id"])):
        machine = row["machine_id"]
        if row["has_failure"]:
            open_now.setdefault(machine, row["reading_id"])
            links[row["reading_id"]] = open_now[machine]
        elif machine in open_now:
            ends[open_now.pop(machine)] = row["timestamp"]
    return links, ends


def test_basic(make_readings):
    df = make_readings([("a", t, f) for t, f in enumerate([0, 1, 1, 0, 1])])
    assert found(df) == [("a", at(1), at(3), 2, False), ("a", at(4), None, 1, True)]


def test_open_episode_of_several_readings_has_no_end(make_readings):
    df = make_readings([("a", t, f) for t, f in enumerate([0, 1, 1])])
    assert found(df) == [("a", at(1), None, 2, True)]


def test_machines_are_independent(make_readings):
    df = make_readings([("a", 0, 1), ("b", 1, 0), ("a", 2, 1), ("b", 3, 1), ("a", 4, 0)])
    assert found(df) == [("a", at(0), at(4), 2, False), ("b", at(3), None, 1, True)]


def test_equal_timestamps_follow_the_id(make_readings):
    df = make_readings([("a", 0, 1), ("a", 0, 0), ("a", 0, 1), ("a", 1, 0)])
    rows = ep.failures(ep.link_episodes(df)).collect()
    assert sorted((r["failure_id"], r["end_time"]) for r in rows) == [(0, at(0)), (2, at(1))]


def skewed(n=400, seed=7):
    """One machine with most rows, long failing stretches, bursts and one dead clock."""
    rng = random.Random(seed)
    rows, failing = [], False
    for i in range(n):
        if rng.random() < 0.08:
            failing = not failing
        machine = "hot" if rng.random() < 0.8 else f"m{rng.randrange(5)}"
        second = 50 if 100 <= i < 180 else rng.choice([i // 3, i * 20])
        rows.append((machine, second, failing))
    return rows


@pytest.mark.parametrize("rows_per_cell", [1, 2, 7, 40, 1000])
def test_split_machines_give_the_same_links(make_readings, rows_per_cell):
    df = make_readings(skewed())
    links, ends = replay(df.collect())
    linked = ep.link_episodes(df, rows_per_cell=rows_per_cell)
    rows = linked.collect()
    assert len(rows) == df.count()
    assert {r["reading_id"]: r["failure_id"] for r in rows if r["failure_id"] is not None} == links
    assert {r["closes"]: r["timestamp"] for r in rows if r["closes"] is not None} == ends
    starts = {r["reading_id"]: r["timestamp"] for r in rows}
    assert all(
        r["failure_start"] == starts[r["failure_id"]] for r in rows if r["failure_id"] is not None
    )


@pytest.mark.parametrize("rows_per_cell", [3, 1000])
def test_carried_state_continues_episodes(spark, make_readings, rows_per_cell):
    df = make_readings([("a", 5, 1), ("a", 6, 0), ("a", 7, 1), ("b", 5, 1), ("b", 6, 1), ("c", 9, 0)])
    carried = spark.createDataFrame(
        [("a", at(1), -5, -9, at(0)), ("b", at(1), -6, None, None), ("c", at(2), -7, -8, at(1))],
        "machine_id string, timestamp timestamp, reading_id bigint, failure_id bigint, "
        "failure_start timestamp",
    )
    rows = ep.link_episodes(df, carried, rows_per_cell).collect()
    assert {r["reading_id"]: (r["failure_id"], r["failure_start"], r["closes"]) for r in rows} == {
        0: (-9, at(0), None),
        1: (None, None, -9),
        2: (2, at(7), None),
        3: (3, at(5), None),
        4: (3, at(5), None),
        5: (None, None, -8),
    }


@pytest.mark.parametrize("rows_per_cell", [5, 50, 10_000])
def test_cells_are_contiguous_and_bounded(make_readings, rows_per_cell):
    df = make_readings(skewed())
    cells = ordered_cells(df, ["machine_id"], rows_per_cell=rows_per_cell)
    rows = sorted(
        cells.rows.collect(), key=lambda r: (r["machine_id"], r["timestamp"], r["reading_id"])
    )
    keys = [(r["machine_id"], r["cell"]) for r in rows]
    assert keys == sorted(keys)
    assert max(keys.count(k) for k in keys) <= rows_per_cell


def test_more_cells_than_allowed_widens_them(make_readings):
    df = make_readings([(f"m{i % 10}", i, 0) for i in range(200)])
    cells = ordered_cells(df, ["machine_id"], rows_per_cell=2, max_cells=4)
    assert cells.rows.count() == 200


@pytest.mark.parametrize("rows_per_cell", [3, 40, 1000])
def test_global_rank(make_readings, rows_per_cell):
    df = make_readings(skewed())
    rows = with_global_rank(df, rows_per_cell=rows_per_cell).collect()
    rows.sort(key=lambda r: (r["timestamp"], r["reading_id"]))
    assert [r["rank"] for r in rows] == list(range(400))


def test_lookback_is_half_open(spark, make_readings):
    from pyspark.sql import functions as F

    df = make_readings([("a", 0, 1), ("b", 1800, 1), ("c", 3600, 1)])
    failures = ep.failures(ep.link_episodes(df))
    recent = ep.in_lookback(failures, F.lit(at(3600)), 1)
    assert {r["machine_id"] for r in recent.collect()} == {"a", "b"}


def test_machines_and_counters(make_readings):
    df = make_readings([("a", 3, 1), ("a", 1, 0), ("a", 5, 0), ("a", 6, 1), ("b", 2, 0)])
    spans = {r["machine_id"]: (r["first_seen"], r["last_seen"]) for r in ep.machines(df).collect()}
    assert spans == {"a": (at(1), at(6)), "b": (at(2), at(2))}
    merged = ep.merge_machines(ep.machines(df), ep.machines(df.filter("timestamp < '2024-01-01 00:00:03'")))
    assert merged.count() == 2
    counters = ep.failure_counters(ep.failures(ep.link_episodes(df))).collect()
    assert [tuple(r) for r in counters] == [("a", 2, 1)]


def test_newest_first(make_readings):
    from millwatch.sources.tables import newest_first

    df = make_readings([("a", 3, 1), ("b", 9, 1), ("c", 5, 1)])
    shown = newest_first(ep.failures(ep.link_episodes(df)), "failures").collect()
    assert [r["machine_id"] for r in shown] == ["b", "c", "a"]
