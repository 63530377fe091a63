import pytest
from conftest import at

from millwatch.schemas import READINGS
from millwatch.sources import messages, tables
from millwatch.streaming import delivery, ingest


def sent(df, seconds):
    """Messages of the given seconds, in any number."""
    rows = df.collect()
    picked = [next(r for r in rows if r["timestamp"] == at(s)) for s in seconds]
    again = df.sparkSession.createDataFrame(picked, df.schema)
    return messages.accepted(messages.decode(messages.encode(again).select("value")))


def sums(spark, root):
    rows = delivery.totals(spark, root).collect()
    return tuple(sum(r[c] for r in rows) for c in ("kept", "repeats", "late"))


def test_every_row_is_kept_repeated_or_late(make_readings, tmp_path):
    seconds = [0, 60, 86_400, 86_460, 90_000]
    df = make_readings([("a" if s < 80_000 else "b", s, False) for s in seconds])
    spark, root = df.sparkSession, str(tmp_path)
    batches = [[0, 0, 60], [86_400, 60, 0], [90_000, 86_400, 86_460, 86_460, 0]]
    kept = []
    for n, batch in enumerate(batches):
        rows = delivery.keep_once(sent(df, batch), n, root, 10)
        kept.append(sorted(r["timestamp"] for r in rows.collect()))
    assert kept == [[at(0), at(60)], [at(86_400)], [at(86_460), at(90_000)]]
    # the second batch's old rows are not behind the first one's time
    assert sums(spark, root) == (5, 5, 1)
    assert sum(sums(spark, root)) == sum(map(len, batches))
    late = tables.read_batches(spark, f"{root}/late", delivery.LATE, by_date=True).collect()
    assert [r["timestamp"] for r in late] == [at(0)]


def test_a_repeated_batch_counts_once_and_a_lost_state_is_an_error(make_readings, tmp_path):
    df = make_readings([("a", 60 * i, False) for i in range(4)])
    spark, root = df.sparkSession, str(tmp_path)
    for n, batch in [(0, [0, 60]), (1, [60, 120, 120]), (1, [60, 120, 120]), (2, [180, 0]), (2, [180, 0])]:
        rows = delivery.keep_once(sent(df, batch), n, root, 10)
        tables.write_batch(rows, f"{root}/readings", n, READINGS, by_date="timestamp")
    assert sums(spark, root) == (4, 3, 0)
    assert tables.read_batches(spark, f"{root}/readings", READINGS, by_date=True).count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        delivery.keep_once(sent(df, [0]), 1, str(tmp_path / "other"), 10)


def test_a_micro_batch_of_nothing(make_readings, tmp_path):
    df = make_readings([("a", 0, False)])
    spark, root = df.sparkSession, str(tmp_path)
    for n, batch in enumerate([[], [0], [], [0]]):
        rows = sent(df, [0]).limit(0) if not batch else sent(df, batch)
        delivery.keep_once(rows, n, root, 10)
    assert sums(spark, root) == (1, 1, 0)


def test_ingest_stores_a_message_delivered_again_once(make_readings, tmp_path):
    df = make_readings([("a", 60 * i, i in (1, 2)) for i in range(4)])
    spark, root = df.sparkSession, str(tmp_path)
    value = messages.encode(df).select("value")
    for n in range(2):
        ingest.ingest_batch(value.unionAll(value), n, root, once=True)
    linked = ingest.current_readings(spark, root).collect()
    assert sorted(r["timestamp"] for r in linked) == [at(60 * i) for i in range(4)]
    assert sums(spark, root) == (4, 12, 0)
