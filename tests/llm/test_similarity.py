import random

import duckdb
import pytest
from texts import no_docs, odd_docs, shingles  # noqa: F401
from pyspark.sql import functions as F

from millwatch.llm import graph, on_documents, similarity

SF = "/root/testdata/sf0.001"


def brute(docs, percent=80):
    """Set size and component of ``(doc_id, text)`` rows by comparing all pairs."""
    sets = [(d, shingles(t)) for d, t in docs]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    lowest = {}
    for i, (d, s) in enumerate(sets):
        if d is not None:
            lowest[root(i)] = min(lowest.get(root(i), d), d)
    return sorted(
        ((d, len(s), lowest.get(root(i)) if s else d) for i, (d, s) in enumerate(sets)), key=repr
    )


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def test_against_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    assert result(on_documents.op6_jaccard_join(spark, SF)) == brute(docs)


@pytest.mark.parametrize("seed", [64, 3])
def test_sizes_and_thresholds(spark, seed):
    """Small sets, sets at the threshold, long chains, large groups and shared passages."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(10**6)
    texts = []
    for n in (1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 40, 90, 200, 400):
        for _ in range(3):
            base = [word() for _ in range(n + 4)]
            texts.append(base)
            for edits in (1, 2, max(1, n // 45), max(1, n // 40)):
                copy = list(base)
                for _ in range(edits):
                    copy[rng.randrange(len(copy))] = word()
                texts.append(copy)
            texts.append(base[: max(1, len(base) * 5 // 6)])
            texts.append(base + [word() for _ in range(max(1, n // 6))])
    chain = [word() for _ in range(120)]
    for i in range(25):  # each links to the next only
        chain = [*chain[:-1], word()] if i % 2 else [word(), *chain[1:]]
        chain[rng.randrange(120)] = word()
        texts.append(chain)
    passage = [word() for _ in range(60)]
    for _ in range(120):  # a shared passage and little else
        texts.append(passage + [word() for _ in range(rng.randrange(8, 60))])
    near = [word() for _ in range(150)]
    for _ in range(120):  # near copies of one text
        copy = list(near)
        copy[rng.randrange(150)] = word()
        texts.append(copy)
    rng.shuffle(texts)
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    assert result(similarity.similar_groups(frame)) == brute(docs)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert result(similarity.similar_groups(odd_docs)) == brute(docs)
    assert similarity.similar_groups(no_docs).count() == 0


def test_bucket_stream_keeps_what_a_join_finds(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(4000):
        cls = rng.randrange(300)
        rows.append((rng.choice([7, 7, rng.randrange(900)]), cls - (2**63 if rng.random() < 0.5 else 0)))
    frame = spark.createDataFrame(rows, "key bigint, member bigint")
    clean = {}
    for k, m in rows:
        clean.setdefault(k, set()).add(m)
    want = sorted(
        (k, m & (2**63 - 1), m < 0)
        for k, ms in clean.items()
        if len(ms) > 1 and min(ms) < 0
        for m in ms
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted(tuple(r) for r in similarity.shared_buckets(frame).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101), (200, 200), (100, 101)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.comp for r in graph.components(frame).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 102: 100, 200: 200}
    assert graph.components(frame.filter(F.lit(False))).count() == 0
