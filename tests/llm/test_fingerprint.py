import hashlib
import random

import duckdb
from pyspark.sql import functions as F

from millwatch.llm import fingerprint, on_documents
from texts import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.001"


def edits(rows):
    """Edited text of ``(doc_id, text)`` rows with distinct ids, by the definition."""
    rows = sorted((i, t or "") for i, t in rows)
    out = {}
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(t) // 4
        out[i] = t[: len(t) - cut] + n[:cut]
    return out


def test_edits_and_equal_texts(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    text = dict(docs)
    want = edits(docs)
    rows = on_documents.op1_fingerprints(spark, SF).collect()
    assert len(rows) == len(docs)
    by_text = {}
    for r in rows:
        assert r.n_chars == len(text[r.doc_id])
        assert r.edited_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault(text[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    long = [r for r in rows if r.n_chars > 200]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)
    order = sorted(rows, key=lambda r: r.doc_id)
    for r, n in zip(order, order[1:], strict=False):
        if r.fingerprint == n.fingerprint:
            assert r.near_next == 1.0


def test_edited_fingerprint_is_that_of_the_edited_text(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 40")
    rows = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    want = edits([(r.doc_id, r.text) for r in docs.collect()])
    # the same lexicon: terms of the same documents, the edited text added under a new id would change it
    band, _ = fingerprint.lexicon(docs.select("doc_id", "text"), fingerprint.LOW_SHARE, fingerprint.HIGH_SHARE)
    edited = spark.createDataFrame([(i, t, i, t) for i, t in want.items()], "doc_id bigint, text string, next_id bigint, edited string")
    for r in fingerprint._marked(edited, band).select("doc_id", fingerprint.as_text(F.col("mark")).alias("f")).collect():
        assert rows[r.doc_id].edited_fingerprint == r.f


def test_odd_rows(spark, odd_docs, no_docs):
    rows = fingerprint.fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    null = next(r for r in rows if r.doc_id is None)
    assert null.near_next == null.near_edited == 1.0
    empty = {r.fingerprint for r in rows if r.doc_id in (0, 1)}
    assert len(empty) == 1
    assert {r.n_chars for r in rows if r.doc_id == 3} == {3, 11}
    assert fingerprint.fingerprints(no_docs).count() == 0
    shuffled = fingerprint.fingerprints(odd_docs, broadcast_terms=0)
    assert sorted(map(repr, shuffled.collect())) == sorted(map(repr, rows))


def test_fingerprint_by_its_definition(spark):
    """Hashes of every random lexicon against sets made by hand, and likeness against the estimate from them."""
    fresh = random.Random(5)
    word_lists = [fresh.sample(range(4000), n) for n in (1, 2, 17, 90, 700, 3000)]
    rows = [(i, " ".join(f"w{x}" for x in words)) for i, words in enumerate(word_lists)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    numbers = {
        r.w: r.n
        for r in spark.createDataFrame([(f"w{x}",) for x in range(4000)], "w string")
        .select("w", fingerprint._number(F.xxhash64("w")).alias("n")).collect()
    }
    found = docs.select("doc_id", F.transform(fingerprint.terms(F.col("text")), fingerprint._number).alias("f"))
    got = {r.doc_id: r.c for r in found.select("doc_id", fingerprint.lexicon_hashes(F.col("f")).alias("c")).collect()}
    held = {}
    for i, words in enumerate(word_lists):
        own = [numbers[f"w{x}"] for x in words]
        for k in range(fingerprint.LEVELS * fingerprint.LEXICONS):
            level, place = divmod(k, fingerprint.LEXICONS)
            width = 2**62 // fingerprint.LEXICONS // 2**level
            members = tuple(sorted(n for n in own if width * place <= n < width * (place + 1)))
            code = got[i][k] if k < len(got[i]) else 0
            assert (code == 0) == (not members)
            # one set has one hash
            assert held.setdefault((k, members), code) == code
        assert sum(1 for c in got[i][: fingerprint.LEXICONS] if c) <= len(own)


def test_likeness_follows_replaced_terms_at_any_length(spark):
    for size in (100, 300, 1000, 3000):
        base = [f"b{i}" for i in range(size)]
        shares = (0.02, 0.1, 0.25, 0.5, 1.0)
        rows = [(0, base)]
        rows += [(k, [f"n{k}x{i}" for i in range(int(size * s))] + base[int(size * s) :]) for k, s in enumerate(shares, 1)]
        frame = spark.createDataFrame(rows, "id bigint, w array<string>").select(
            "id", fingerprint.print_of(F.transform("w", lambda x: fingerprint._number(F.xxhash64(x))), F.lit(0).cast("bigint")).alias("m")
        )
        first = frame.filter("id = 0").select(F.col("m").alias("o"))
        both = frame.join(F.broadcast(first)).orderBy("id")
        near = [r[0] for r in both.select(fingerprint.likeness(F.col("m"), F.col("o"))).collect()]
        assert near[0] == 1.0 and near == sorted(near, reverse=True)
        for s, got in zip(shares, near[1:], strict=True):
            assert abs(got - (1 - s) / (1 + s)) < 0.2


def test_only_document_follows_itself(spark):
    one = spark.createDataFrame([(7, "abcdefgh")], "doc_id bigint, text string")
    row = fingerprint.fingerprints(one).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert row.near_next == 1.0


def test_any_kept_term_shows_in_a_long_text(spark):
    words = [f"t{i}" for i in range(3000)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:-1]))]
    # all words but the last, which stands in the lexicon as well, are common to both texts
    rows += [(2, "t2999 alone"), (3, "t2998 t2999")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs, high_share=1.0).collect()}
    assert got[0].fingerprint != got[1].fingerprint
    assert 0.5 < got[0].near_next < 1.0
    many = [(i, " ".join(words[:i] + words[i + 1 :])) for i in range(10, 30)]
    docs = spark.createDataFrame(many, "doc_id bigint, text string")
    assert len({r.fingerprint for r in fingerprint.fingerprints(docs, high_share=1.0).collect()}) == 20
