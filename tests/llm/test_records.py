import struct
import uuid
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millwatch.llm import on_documents, records
from millwatch.llm.store import keep
from millwatch.session import scratch_path
from texts import no_docs, odd_docs  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(on_documents.tokenizer_path())


def expected(tokenizer, rows):
    start, out = 0, []
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(tuple(r) for r in on_documents.op9_binary_records(spark, SF).collect())
    assert got == expected(tokenizer, [tuple(r) for r in docs])


def test_odd_texts(spark, tokenizer, odd_docs, no_docs):
    special = ["x<|startoftext|>y <|ENDOFTEXT|>", "Don't STOP 3.14e-7 a'sb 'LL 24be64439e", "á e̸< ≮ .́a 1⃣ Å", "é, —, x—, $é É"]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(special)], "doc_id bigint, text string")
    frame = odd_docs.select("doc_id", "text").union(more)
    rows = sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    got = on_documents.encoded(frame).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected(tokenizer, rows), key=key)
    assert on_documents.encoded(no_docs).count() == 0


def test_shuffled_reads_and_damage(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder = scratch_path(spark, "records")
    index, _ = keep(records.write(docs, folder, on_documents.tokenizer_path()), "index")
    some = index.filter("doc_id % 7 = 3").orderBy(F.rand(1))
    got = {r.doc_id: r.ids for r in records.fetch(some, folder).collect()}
    for r in docs.filter("doc_id % 7 = 3").collect():
        assert got[r.doc_id] == [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2]
    names = [r.file for r in index.select("file").distinct().orderBy("file").collect()]
    lows = [index.filter(F.col("file") == n).agg(F.min("doc_id"), F.max("doc_id")).first() for n in names]
    assert all(a[1] < b[0] for a, b in zip(lows, lows[1:], strict=False))
    path = f"{folder.removeprefix('file://')}/{names[0]}"
    with open(path, "r+b") as file:
        file.seek(40)
        byte = file.read(1)
        file.seek(40)
        file.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="damaged record"):
        records.read(index, folder).collect()


def test_frame_layout():
    data = records.frame(5, np.array([1, 70000]), 4)
    (n,) = struct.unpack_from("<Q", data)
    assert len(data) == n + 16 and records.unframe(data[12:-4])[0] == 5
    assert records.unframe(records.frame(None, np.array([3]), 2)[12:-4])[0] is None
    assert uuid.UUID(int=records.masked(b"abc")).int <= 0xFFFFFFFF
