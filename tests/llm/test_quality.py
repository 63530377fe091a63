import zlib

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millwatch.llm import on_documents, quality
from texts import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    rows = on_documents.op7_quality(spark, SF).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.95


def test_matches_the_formula(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, quality.D)) * np.arange(1, quality.D + 1)
    y = (np.arange(300) % 3 > 0).astype(int)
    x[y == 1] += 0.7
    frame = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y, strict=True)], "x array<double>, y int")
    model = quality.fit(frame)
    pooled = sum(np.cov(x[y == c].T, bias=True) * np.mean(y == c) for c in (0, 1))
    scale = np.sqrt(np.diag(pooled))
    logs = []
    for c in (0, 1):
        own = np.cov(x[y == c].T, bias=True) / np.outer(scale, scale)
        own = 0.9 * own + 0.1 * pooled / np.outer(scale, scale)
        own = 0.98 * own + 0.02 * np.trace(own) / quality.D * np.eye(quality.D)
        z = (x - x[y == c].mean(0)) / scale
        logs.append(np.log(np.mean(y == c)) - 0.5 * np.linalg.slogdet(own)[1] - 0.5 * np.einsum("ni,ij,nj->n", z, np.linalg.inv(own), z))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(3, 1, 0), (4, 0, 0), (5, 1, 0), (7, 0, 0), (8, None, 0), (None, 1, 0), (6, 0, 0), (6, 1, 0), (99, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    rows = quality.score(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(np.isfinite(r.score) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (0, 1)}) == 1
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert {r.score for r in quality.score(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(no_docs, labels).count() == 0
    kept = quality.accepted(odd_docs, labels)
    scores = {(r.doc_id, round(r.score, 9)) for r in rows if r.predicted}
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r.predicted for r in rows) and scores


def test_statistics_do_not_depend_on_slices():
    texts = ["a b c", None, "x" * 5000, "Word word WORD 12 $$", ""] * 3
    whole = quality.statistics(pa.array(texts))
    assert np.allclose(whole, np.concatenate([quality.statistics(pa.array([t], pa.string())) for t in texts]))


def test_held_out_of_null(spark):
    assert spark.range(1).select(quality.held_out(F.lit(None).cast("bigint"))).first()[0] is False
