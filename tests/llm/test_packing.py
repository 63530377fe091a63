import random
import zlib
from random import Random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millwatch.llm import on_documents, packing
from millwatch.llm.store import keep
from texts import SF, no_docs, odd_docs  # noqa: F401


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(on_documents.tokenizer_path())


def cut(tokenizer, rows, capacity=4096):
    out = []
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((d, k, at, len(part), zlib.crc32(part.tobytes())))
    return out


def fills(rows, capacity):
    """Checks that every sequence is gapless and not too long, and gives their number."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def same(rows, expected):
    key = lambda r: (r[0] is not None, *[x or 0 for x in r])
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    rows = on_documents.op13_packing(spark, SF).collect()
    expected = cut(tokenizer, [tuple(d) for d in docs])
    same(rows, expected)
    assert fills(rows, 4096) <= -(-sum(e[3] for e in expected) // 4096) + 1


def test_odd_documents(spark, tokenizer, odd_docs, no_docs):  # noqa: F811
    rows = packing.packed(odd_docs, on_documents.tokenizer_path(), capacity=50).collect()
    same(rows, cut(tokenizer, [(r.doc_id, r.text) for r in odd_docs.collect()], 50))
    fills(rows, 50)
    assert packing.packed(no_docs, on_documents.tokenizer_path()).collect() == []


def test_levels(spark):
    """Many shards: what they leave is packed again until one shard is left."""
    rng = random.Random(8)
    sizes = [rng.choice([rng.randrange(1, 40), rng.randrange(30, 70), 100]) for _ in range(3000)]
    frame, _ = keep(spark.createDataFrame(list(enumerate(sizes)), "row bigint, length bigint"), "lengths")
    rows = frame.join(packing.pack(frame, 100, shard=100), "row").collect()
    assert len(rows) == 3000 and len({r.row for r in rows}) == 3000
    bins = fills(rows, 100)
    assert bins <= len(packing.best_fit([s for s in sizes if s < 100], 100)) + sizes.count(100) + 3
    equal = spark.range(500).select(F.col("id").alias("row"), F.lit(60).cast("bigint").alias("length"))
    assert fills(equal.join(packing.pack(equal, 100, shard=64), "row").collect(), 100) == 500


def valid(bins, sizes, capacity):
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(0 < sum(sizes[i] for i in b) <= capacity for b in bins)


def test_genetic_operators():
    rng = Random(3)
    for seed in range(5):
        sizes = [rng.randrange(20, 60) for _ in range(120)]
        a = packing.best_fit(sizes, 100)
        b = packing.best_fit(sizes, 100, rng.sample(range(120), 120))
        for made in (packing.crossover(a, b, sizes, 100, rng), packing.mutated(b, sizes, 100, rng)):
            valid(made, sizes, 100)
        child = packing.crossover(a, b, sizes, 100, Random(seed))
        whole = {frozenset(x) for x in b if sum(sizes[i] for i in x) >= 98}
        assert not whole or whole & {frozenset(x) for x in child}
        best = packing.evolved(sizes, 100, [a, b], seed)
        valid(best, sizes, 100)
        assert packing.fitness(best, sizes, 100) <= min(packing.fitness(x, sizes, 100) for x in (a, b))


def test_evolution_beats_best_fit():
    """Perfect packings of three that best fit decreasing misses."""
    rng, better = Random(1), 0
    for seed in range(6):
        sizes = []
        for _ in range(30):
            x, y = rng.randrange(250, 400), rng.randrange(250, 400)
            sizes += [x, y, 1000 - x - y]
        rng.shuffle(sizes)
        start = packing.best_fit(sizes, 1000)
        bins = start
        for epoch in range(6):
            bins = packing.evolved(sizes, 1000, [bins], seed * 10 + epoch)
        better += packing.fitness(bins, sizes, 1000) < packing.fitness(start, sizes, 1000)
        assert len(bins) <= len(start)
    assert better >= 4
