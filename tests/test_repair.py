"""Late readings repair episodes; state and episodes are written without growing with history."""

import os
import random
from pathlib import Path

import pytest
from conftest import at
from pyspark.sql import functions as F

from millwatch.operators import episodes as ep
from millwatch.sources import messages
from millwatch.sources.commits import Commits, Taken
from millwatch.streaming import ingest


def episode_rows(failures):
    columns = ["machine_id", "start_time", "end_time", "n_readings", "is_active"]
    return sorted(map(str, failures.select(columns).collect()))


def reading_rows(linked):
    episode = F.struct("machine_id", "timestamp", "has_failure", "failure_start", F.col("closes").isNotNull())
    return sorted(map(str, linked.select(episode).collect()))


def send(df, root, part, **options):
    ingest.ingest_batch(messages.encode(df).select("value"), part, root, **options)


def compare(df, root):
    linked = ep.link_episodes(df)
    assert episode_rows(ingest.current_failures(df.sparkSession, root)) == episode_rows(ep.failures(linked))
    assert reading_rows(ingest.current_readings(df.sparkSession, root)) == reading_rows(linked)


@pytest.mark.parametrize(("seed", "rows_per_cell"), [(1, 1_000_000), (2, 7)])
def test_any_order_equals_batch(make_readings, tmp_path, seed, rows_per_cell):
    rng = random.Random(seed)
    rows, failing, second = [], {}, 0
    for _ in range(160):
        second += rng.choice([60, 600, 600, 40_000])  # many days, some without readings
        machine = "hot" if rng.random() < 0.5 else f"m{rng.randrange(3)}"
        if rng.random() < 0.3:
            failing[machine] = not failing.get(machine, False)
        rows.append((machine, second, failing.get(machine, False)))
    df = make_readings(rows)
    spark, root = df.sparkSession, str(tmp_path)
    mixed = df.withColumn("part", F.pmod(F.xxhash64("reading_id", F.lit(seed)), F.lit(3)))
    for part in range(3):
        one = mixed.filter(F.col("part") == part).drop("part")
        send(one, root, part, rows_per_cell=rows_per_cell, compact_every=2)
        if part == 1:  # a repeated micro-batch replaces itself, repairs too
            send(one, root, part, rows_per_cell=rows_per_cell, compact_every=2)
    compare(df, root)
    seen = ingest.current_machines(spark, root, 2)
    assert sorted(map(str, seen.collect())) == sorted(map(str, ep.machines(df).collect()))


CASES = [
    ([(10, 1), (20, 1), (30, 1), (40, 0)], [(25, 0)]),  # split
    ([(10, 1), (20, 0), (30, 1), (40, 0)], [(5, 1)]),  # earlier start
    ([(10, 1), (30, 0), (50, 0)], [(20, 1), (40, 1)]),  # longer, and a new one
    ([(30, 1), (40, 1)], [(10, 1)]),  # an open episode gets another start
    ([(10, 1), (40, 1)], [(20, 0)]),  # an open episode is split
    ([(10, 1), (40, 0)], [(20, 0)]),  # an earlier end
    ([(100_000, 1), (500_000, 1), (900_000, 0)], [(300_000, 0), (50_000, 1)]),  # days in between
    ([(10, 0), (900_000, 1), (900_010, 0)], [(400_000, 1)]),  # joins the next episode, days later
    ([(20, 1), (30, 0)], [(20, 0)]),  # one instant
    ([(10, 1), (20, 1), (950_000, 0), (950_001, 1)], [(15, 1), (16, 0), (17, 1), (940_000, 0)]),
]


def test_each_repair(make_readings, tmp_path):
    root, parts = str(tmp_path), [[], [], []]
    for k, (stored, late) in enumerate(CASES):
        parts[0] += [(f"c{k}", *r) for r in stored]
        parts[1] += [(f"c{k}", *r) for r in late]
        parts[2] += [(f"c{k}", 960_000, 1), (f"c{k}", 960_010, 0)]
    ends = [len(parts[0]), len(parts[0]) + len(parts[1]), sum(map(len, parts))]
    df = make_readings([r for p in parts for r in p])
    for part, (low, high) in enumerate(zip([0, *ends], ends, strict=False)):
        send(df.filter(F.col("reading_id").between(low, high - 1)), root, part)
        if part:
            compare(df.filter(F.col("reading_id") < high), root)


def written(root, since):
    return sum(p.stat().st_size for p in Path(root).rglob("*.parquet") if p.stat().st_mtime_ns > since)


def test_work_does_not_grow_with_history(make_readings, tmp_path):
    """Every micro-batch is of one machine's day; many machines and days lie behind it."""
    root, sizes = str(tmp_path), []
    spark = None
    for part in range(9):
        df = make_readings([(f"m{part}", part * 86_400 + i, i % 3 == 1) for i in range(6)])
        spark, since = df.sparkSession, max([0, *(p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet"))])
        send(df, root, part, compact_every=3)
        sizes.append(written(root, since))
    assert max(sizes[6:]) <= 1.1 * max(sizes[:3])
    state = [p for p in Path(root, "state").rglob("*.parquet")]
    assert len(state) <= 9 + 2 and len(list(Path(root, "state/_commits").glob("*.json"))) == 2
    assert len(list(Path(root, "failures/changes").glob("batch_id=*"))) == 3  # those of the last compaction
    assert ingest.current_failures(spark, root).count() == 18
    commits = Commits(spark, f"{root}/failures/_commits")
    number, live = commits.newest()
    assert number == 8 and len(live["days"]) == 9 and len(set(live["days"].values())) == 3


def test_a_compaction_that_dies_loses_nothing(make_readings, tmp_path, monkeypatch):
    df = make_readings([("a", i * 7_200, i % 4 in (1, 2)) for i in range(48)])
    root, spark = str(tmp_path), df.sparkSession
    part_of = F.floor(F.col("reading_id") / 8)
    for part in range(4):
        send(df.filter(part_of == part), root, part, compact_every=2)

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(ingest.Commits, "replace", lambda self, n, c, real=Commits.replace: dies() if "failures" in self.path else real(self, n, c))
        send(df.filter(part_of == 4), root, 4, compact_every=2)
        with pytest.raises(OSError, match="lost"):
            send(df.filter(part_of == 5), root, 5, compact_every=2)
    compare(df, root)  # readers see the version before and its changes
    send(df.filter(part_of == 5), root, 5, compact_every=2)
    compare(df, root)
    assert Commits(spark, f"{root}/failures/_commits").newest()[0] == 5


def test_a_new_checkpoint_over_an_old_root_is_refused(make_readings, tmp_path):
    df = make_readings([("a", i, 0) for i in range(3)])
    root = str(tmp_path)
    for part in range(2):
        send(df.filter(F.col("reading_id") == part), root, part)
    with pytest.raises(RuntimeError, match="later micro-batches"):
        send(df, root, 0)


def test_commits(spark, tmp_path):
    a, b = Commits(spark, str(tmp_path / "log")), Commits(spark, f"file://{tmp_path}/log")
    assert a.newest() == (-1, None) and a.numbers() == [] and a.next_free() == 0
    a.create(0, {"x": 1})
    with pytest.raises(Taken):
        b.create(0, {"x": 2})
    assert b.get(0) == {"x": 1} and b.next_free() == 1
    b.create(1, {"x": 3})
    b.replace(1, {"x": 4})
    assert a.newest() == (1, {"x": 4})
    with pytest.raises(FileNotFoundError, match="does not exist"):
        a.get(7)
    assert not [n for n in os.listdir(tmp_path / "log") if n.startswith(".0") and not n.endswith(".crc")]
    assert at(1) > at(0)
