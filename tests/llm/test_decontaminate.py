import math

import duckdb
from texts import no_docs, odd_docs, shingles, words  # noqa: F401

from millwatch.llm import decontaminate as D
from millwatch.llm import on_documents

SF = "/root/testdata/sf0.001"


def brute(docs, items, threshold=0.8):
    found = {}
    for i, item in items:
        if not words(item):
            continue
        width = min(5, len(words(item)))
        mine = shingles(item, width)
        for d, text in docs:
            w = words(text)
            theirs = set(zip(*[w[j:] for j in range(width)], strict=False))
            if len(mine & theirs) >= math.ceil(threshold * len(mine) - 1e-9):
                found[d, i] = len(mine & theirs)
    return found


def result(df):
    return {(r.doc_id, r.item_id): r.n_shared for r in df.collect()}


def test_against_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    assert result(on_documents.op2_decontamination(spark, SF)) == brute(docs, items)


def test_partial_passages_and_blocks(spark):
    item = [f"w{i}" for i in range(24)]  # 20 shingles, 16 are needed
    docs = [
        (1, "before " + " ".join(item[:20]) + " after"),  # 16 shingles
        (2, "before " + " ".join(item[:19]) + " after"),  # 15
        (3, " ".join(item).upper()),
        (4, "filler " * 5000 + " ".join(item) + " filler" * 5000),
        (5, " ".join(item[:12] + ["gap"] + item[12:])),  # 16 left
    ]
    items = [(10, " ".join(item)), (11, "two words"), (12, " ".join(item))]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute(docs, items)
    assert {(1, 10), (3, 12), (4, 10), (5, 10)} <= set(want) and (2, 10) not in want
    assert result(D.contaminated(frame, bench)) == want
    assert result(D.contaminated(frame, bench, index_bytes=100)) == want
    assert [r.doc_id for r in D.decontaminate(frame, bench, index_bytes=100).collect()] == [2]


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, None), (2, ""), (3, "one"), (4, "word " * 7), (None, "one two three four five"), (3, "one")]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, doc_id string")
    rows = D.contaminated(odd_docs, bench).collect()
    want = []
    for r in odd_docs.collect():
        for i, t in items:
            if brute([(0, r.text)], [(0, t)]):
                want.append((r.doc_id, i))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.item_id)) for r in rows)
    kept = D.decontaminate(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    hit = {r.doc_id for r in rows}
    assert all(r.doc_id not in hit or r.text == "other words" for r in kept.collect())
    assert D.contaminated(no_docs, bench).count() == 0
    assert D.contaminated(odd_docs, bench.limit(0)).count() == 0
    assert D.decontaminate(odd_docs, bench.limit(0)).count() == odd_docs.count()
