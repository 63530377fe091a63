"""The pipeline on a small table, each stage checked on its own input."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
from tokenizers import Tokenizer

from millwatch.llm import on_documents
from test_decontaminate import brute as leaks
from test_mixing import targets
from test_similarity import brute as groups
from texts import words

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    rows = [df.collect() for df in seen]
    assert all(df.columns == docs.columns for df in seen[:-1])
    kept = {r.doc_id for r in rows[1]}
    held = [d for d in label if zlib.crc32(str(d).encode()) % 3 == 1]
    assert np.mean([(d in kept) == (label[d] == 1) for d in held]) > 0.9
    lead = {d for d, _, c in groups([(r.doc_id, r.text) for r in rows[1]]) if c == d}
    assert {r.doc_id for r in rows[2]} == lead and len(rows[2]) == len(lead)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = {d for d, _ in leaks([(r.doc_id, r.text) for r in rows[2]], items)}
    assert {r.doc_id for r in rows[3]} == {r.doc_id for r in rows[2]} - found and found
    times = {}
    for r in rows[4]:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert set(times) <= {r.doc_id for r in rows[3]}
    size = Counter()
    for r in rows[3]:
        size[r.source] += len(words(r.text))
    want, per_source = targets(size), Counter()
    for r in rows[3]:
        per_source[r.source] += times.get(r.doc_id, 0) * len(words(r.text))
    near = max(len(words(r.text)) for r in rows[3]) / 2
    assert all(abs(per_source[s] - t) <= near for s, t in want.items()) and max(times.values()) <= 3
    code = Tokenizer.from_file(on_documents.tokenizer_path())
    want = [len(code.encode(r.text, add_special_tokens=False).ids) + 1 for r in rows[4]]
    assert sorted(want) == sorted(r.n_tokens for r in rows[5])
    assert sum(want) == max(r.start + r.n_tokens for r in rows[5])


def test_null_ids_and_repeated_rows(spark):
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(40))
    row = lambda i, k, source="a": (i, text(k), "en", source, len(text(k)))
    rows = [row(1, 1), row(1, 1), row(1, 1), row(2, 1), row(None, 1), row(None, 1), row(3, 1), row(3, 2), row(None, 3), row(None, 4), row(None, 4)]
    joined = corpus_pipeline.jaccard_join(spark, spark.createDataFrame(rows, kind), SF)
    got = sorted(map(tuple, joined.collect()), key=repr)
    assert got == sorted([row(1, 1), row(3, 2), row(None, 3), row(None, 4)], key=repr)
    rows += [row(5, 5, None), row(5, 6, None), (6, text(7), None, "a", 3), (6, text(7), "a", None, 3)]
    # one source only per null: every row is taken once or more, never n x n times
    docs = spark.createDataFrame(rows, kind)
    want = {}
    for r in corpus_pipeline.mixing.mix(corpus_pipeline.keyed(docs), (5.0, 2.0, 1.0), doc_id="key").collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.epochs
    mixed = corpus_pipeline.source_mix(spark, docs, SF)
    times = {}
    for r in corpus_pipeline.keyed(mixed).collect():
        times[r.key] = times.get(r.key, 0) + 1
    assert times == {k: n for k, n in want.items() if n}
    assert any(r.doc_id is None for r in mixed.collect())
    assert abs(mixed.count() - len(rows)) <= 2


def test_no_documents(spark):
    docs = spark.createDataFrame([], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
