"""Short benchmark items inside long documents: MinHash containment search, exactly verified.

An item is in a document if at least ``threshold`` of its distinct word shingles occur there. The
items are partitioned by size (powers of two of their shingle count). Every class has its own
number of minimum hashes: an item that is contained lacks at most ``n - ceil(threshold * n)``
shingles, so with ``k`` minima taken from the item, at least ``k`` less that number occur among
the document's shingles. Comparing the minima of the short item with all shingles of the long
document, instead of with minima of the document, is what keeps containment search exact when
the sizes differ a thousandfold. Candidates are verified on the words themselves.

The documents are read once and never shuffled; the index of the items is what travels. It is cut
into blocks of bounded size, and each block makes one more pass over the documents.

Edge cases: null and empty documents contain nothing; null and empty items are found nowhere.
An item of fewer than five words is one shingle, its whole sequence, found as a run of that many
words. Repeated items are each reported, repeated documents too (rows are never merged). Columns
besides the named ones are ignored by the search and kept by the filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import keep

INDEX_BYTES = 32_000_000
"""Largest block of the item index that is sent to the executors at once."""

_FILTER_BITS = 20

HITS = "doc_id bigint, item_id bigint, n_shingles bigint, n_shared bigint, containment double"


def item_blocks(
    items: DataFrame, item_id: str, text: str, index_bytes: int
) -> tuple[DataFrame, int]:
    """The items with their block, stored, and the number of blocks."""
    named = items.select(
        F.col(item_id).cast("bigint").alias("item_id"), F.col(text).cast("string").alias("text")
    ).filter(F.length("text") > 0)
    # a shingle weighs 8 bytes in the index, and at most every second character starts one
    weight = named.agg(F.sum(F.length("text") * 8)).first()[0] or 0
    n = max(1, -(-int(weight) // index_bytes))
    blocked = named.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    return (keep(blocked, "items")[0] if n > 1 else blocked), n


class Index:
    """Minimum hashes and shingles of one block of items."""

    def __init__(self, rows: list[tuple[int | None, str]], threshold: float):
        self.threshold = threshold
        column = pa.array([text for _, text in rows], pa.string())
        split = W.split(column)
        counts = split.counts
        self.ids = [item for item, _ in rows]
        self.words = [W.folded_words(text) for _, text in rows]
        self.widths = np.minimum(counts, W.WIDTH)
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.size = np.zeros(len(rows), np.int64)
        self.enough = np.zeros(len(rows), np.int64)
        missing = np.zeros(len(rows), np.int64)
        sets: dict[int, np.ndarray] = {}
        for width in sorted({int(w) for w in self.widths if w}):
            values, bounds = W.shingles(split, width, short=False)
            for i in np.flatnonzero(self.widths == width):
                sets[i] = np.unique(values[bounds[i] : bounds[i + 1]])
                n = len(sets[i])
                self.size[i] = n
                missing[i] = n - self.needed(i)
        classes = np.zeros(len(rows), np.int64)
        classes[self.size > 0] = np.log2(self.size[self.size > 0]).astype(np.int64)
        for width in sorted({int(w) for w in self.widths if w}):
            hashes, owners = [], []
            for c in np.unique(classes[self.widths == width]):
                members = np.flatnonzero((self.widths == width) & (classes == c))
                k = 2 * int(missing[members].max()) + 1
                for i in members:
                    sketch = sets[i][:k]
                    self.enough[i] = len(sketch) - missing[i]
                    hashes.append(sketch)
                    owners.append(np.full(len(sketch), i))
            value, owner = np.concatenate(hashes), np.concatenate(owners)
            order = np.argsort(value, kind="stable")
            quick = np.zeros(1 << _FILTER_BITS, bool)
            quick[value & np.uint64(quick.size - 1)] = True
            self.by_width[width] = value[order], owner[order], quick

    def search(self, column: pa.Array) -> Iterator[tuple[int, int, int]]:
        """``(row, item, shared shingles)`` of every item found in every row."""
        split = W.split(column)
        for width, (value, owner, quick) in self.by_width.items():
            shingle, bounds = W.shingles(split, width, short=False)
            maybe = np.flatnonzero(quick[shingle & np.uint64(quick.size - 1)])
            low = np.searchsorted(value, shingle[maybe], "left")
            high = np.searchsorted(value, shingle[maybe], "right")
            hit = high > low
            if not hit.any():
                continue
            row = np.searchsorted(bounds, maybe[hit], "right") - 1
            n = (high - low)[hit]
            at = np.repeat(low[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found = np.unique(np.stack([np.repeat(row, n), owner[at], at]), axis=1)
            pair, seen = np.unique(found[:2], axis=1, return_counts=True)
            for r, i in pair[:, seen >= self.enough[pair[1]]].T:
                shared = self.verified(column[int(r)].as_py(), i, width)
                if shared >= self.needed(i):
                    yield int(r), int(i), shared

    def needed(self, i: int) -> int:
        return math.ceil(self.threshold * int(self.size[i]) - 1e-9)

    def verified(self, text: str, i: int, width: int) -> int:
        """Distinct shingles of the item that the text has, compared word by word."""
        mine = self.words[i]
        wanted = {tuple(mine[j : j + width]) for j in range(len(mine) - width + 1)}
        theirs = W.folded_words(text)
        return len(wanted.intersection(zip(*[theirs[j:] for j in range(width)], strict=False)))


def _blocks(
    items: DataFrame, item_id: str, text: str, threshold: float, index_bytes: int
) -> Iterator[Index]:
    """The index of the items, block by block."""
    blocked, n = item_blocks(items, item_id, text, index_bytes)
    for block in range(n):
        part = blocked.filter(F.col("block") == block) if n > 1 else blocked
        yield Index([(r["item_id"], r["text"]) for r in part.collect()], threshold)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.8,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """One row per document and item found in it: ids, item size, shared shingles, containment."""
    spark = docs.sparkSession
    named = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    hits = spark.createDataFrame([], HITS)
    for index in _blocks(items, item_id, item_text, threshold, index_bytes):
        shared = spark.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for part in W.slices(batch, "text"):
                    found = list(index.search(part.column("text")))
                    ids = part.column("doc_id")
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array([ids[r].as_py() for r, _, _ in found], pa.int64()),
                            "item_id": pa.array([index.ids[i] for _, i, _ in found], pa.int64()),
                            "n_shingles": pa.array([int(index.size[i]) for _, i, _ in found], pa.int64()),
                            "n_shared": pa.array([n for _, _, n in found], pa.int64()),
                            "containment": pa.array([n / int(index.size[i]) for _, i, n in found], pa.float64()),
                        }
                    )

        hits = hits.union(named.mapInArrow(search, HITS))
    return hits


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = 0.8,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item."""
    clean = docs
    for index in _blocks(items, item_id, item_text, threshold, index_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def drop(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in W.slices(batch, text):
                    free = np.ones(part.num_rows, bool)
                    free[[r for r, _, _ in shared.value.search(part.column(text))]] = False
                    yield part.filter(pa.array(free))

        clean = clean.mapInArrow(drop, docs.schema)
    return clean
