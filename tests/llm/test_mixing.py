from collections import Counter

import duckdb
from texts import no_docs, odd_docs, words  # noqa: F401

from pyspark.sql import functions as F

from millwatch.llm import mixing, on_documents

SF = "/root/testdata/sf0.001"


def targets(sizes, weights=(5, 2, 1)):
    """Shares by weight, capped at three times the size, the excess shared again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[n] for n in capped)
        room = sum(weight[n] for n in names if n not in capped)
        out = {n: 3.0 * sizes[n] if n in capped else rest * weight[n] / room for n in names}
        new = {n for n in names if n not in capped and out[n] > 3 * sizes[n] + 1e-9}
        if not new:
            return out
        capped |= new


def check(rows, docs, near):
    size = {}
    for d, t, s in docs:
        size.setdefault(s, 0)
        size[s] += len(words(t))
    want = targets(size)
    taken = Counter()
    for r in rows:
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert r.source_size == size[r.source]
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= near


def test_targets_and_epochs(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, source FROM '{SF}/documents.parquet'").fetchall()
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(frame, cell_rows=3).collect()
    check(rows, docs, max(len(words(t)) for _, t, _ in docs) / 2)
    for r in rows:
        whole = int(r.target / r.source_size + 1e-12)
        assert r.epochs in (whole, whole + 1)
    again = on_documents.op4_mixing(spark, SF).collect()
    assert {r.doc_id: r.taken for r in mixing.mix(frame.repartition(7)).collect()} == {
        r.doc_id: r.taken for r in again
    }


def test_caps_reshare(spark):
    docs = [(i, "w " * 10, "a") for i in range(3)] + [(10 + i, "w " * 10, "b") for i in range(200)]
    docs += [(1000 + i, "w " * 7, None) for i in range(100)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    rows = mixing.mix(frame).collect()
    check(rows, docs, 10)
    assert {r.target for r in rows if r.source == "a"} == {90.0}
    assert all(r.epochs == 3 for r in rows if r.source == "a")


def test_heavier_documents_are_taken_more_often(spark):
    prose = [(i, "average words here now " * 20, "a") for i in range(2000)]
    noise = [(5000 + i, "a b c d " * 20, "a") for i in range(2000)]
    other = [(9000 + i, "average words here now " * 20, "b") for i in range(2000)]
    frame = spark.createDataFrame(prose + noise + other, "doc_id bigint, text string, source string")
    rows = mixing.mix(frame, weights=(1.0, 3.0)).collect()
    a = [r for r in rows if r.source == "a" and r.epochs]
    assert sum(r.doc_id < 5000 for r in a) > 1.2 * sum(r.doc_id >= 5000 for r in a)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == len(docs)
    check(rows, docs, 30000)
    assert all(r.taken == 0 for r in rows if r.doc_id in (0, 1, 2))
    assert mixing.mix(no_docs).count() == 0


def test_cuts_say_what_the_mix_takes(spark):
    """Bounds per source and the few unsettled documents give the epochs of every id."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    docs = docs.union(docs.filter("doc_id % 3 = 0")).union(docs.filter("doc_id % 3 = 0"))
    want = {}
    for r in mixing.mix(docs, cell_rows=7).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.epochs
    bounds, unsettled = mixing.cuts(docs, cell_rows=50)
    assert bounds.count() == docs.select("source").distinct().count()
    got = {r.doc_id: r.epochs for r in unsettled.collect()}
    assert len(got) <= 2 * bounds.count()
    settled = mixing.with_epochs(docs.withColumn("cut", F.lit(1)), bounds)
    assert settled.columns == ["doc_id", "text", "source", "cut", "epochs"]
    edge = set(got)
    for r in settled.collect():
        if r.doc_id not in edge:
            got[r.doc_id] = got.get(r.doc_id, 0) + r.epochs
    assert got == want


def test_cells_stay_small_and_in_order(spark):
    """Under any weight a cell holds about as many rows as asked for, and cells follow the keys."""
    for weight in (0.25, 1.0):
        key = -F.log((F.pmod(F.xxhash64("id"), F.lit(1 << 53)) + 0.5) / float(1 << 53)) / weight
        rows = spark.range(60_000).select(F.lit("a").alias("source"), key.alias("key"))
        cells = mixing.with_cells(rows, 200).groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        found = sorted(cells.collect())
        assert max(r.n for r in found) < 400 and sum(r.n for r in found) == 60_000
        assert all(a.high < b.low for a, b in zip(found, found[1:], strict=False))
