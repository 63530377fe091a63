import itertools
import zlib

import duckdb
import numpy as np
import pyarrow as pa

from millwatch.llm import language as L
from millwatch.llm import on_documents
from texts import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    rows = on_documents.op10_language(spark, SF).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 5, 3]
    score, transition = rng.normal(size=(9, 3)), rng.normal(size=(3, 3))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    posterior, expected = L.forward_backward(score, bounds, transition, True)
    moves = np.zeros((3, 3))
    for low, high in itertools.pairwise(bounds):
        total, own = 0.0, np.zeros((high - low, 3))
        pairs = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(high - low) + 1):
            weight = np.exp(sum(score[low + i, c] + transition[path[i], c] for i, c in enumerate(path[1:])))
            total += weight
            for i, c in enumerate(path[1:]):
                own[i, c] += weight
                pairs[path[i], c] += weight
        assert np.allclose(posterior[low:high], own / total)
        moves += pairs / total
    assert np.allclose(expected, moves)


def test_segments_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    score, transition = rng.normal(size=(700, 4)) * 3, rng.normal(size=(4, 4))
    bounds = np.array([0, 3, 3, 503, 700])
    whole = L.forward_backward(score, bounds, transition, True)
    monkeypatch.setattr(L, "SEGMENT", 9)
    for a, b in zip(whole, L.forward_backward(score, bounds, transition, True), strict=True):
        assert np.allclose(a, b)


def test_code_switching():
    en = "the thing with the other and then whether through this that there".split()
    de = "der nicht auch werden sich schon zwischen durch eine über".split()
    texts = [" ".join(np.random.default_rng(i).permutation(en if i % 2 else de)) for i in range(60)]
    field = L.fit(texts, ["en" if i % 2 else "de" for i in range(60)])
    names, share = L.label(field, pa.array([" ".join(en * 3 + de), " ".join(de * 3 + en), " ".join(en)]))
    assert names == ["en", "de", "en"] and share[0] < 0.9 < share[2]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = L.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id != 3}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (0, 1, 2, 10))
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in L.identify(odd_docs.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}
    assert L.identify(no_docs).count() == 0
