"""Packing of token sequences by a grouping genetic algorithm on islands.

Documents are encoded and cut into pieces of at most ``CAPACITY`` tokens. Only lengths are packed: pieces are
dealt to shards of about ``SHARD`` pieces by a hash of their row, and every shard is packed by itself on
``ISLANDS`` islands, populations with seeds of their own. An individual is a grouping of the shard's
pieces into bins. A child takes whole well-filled bins of one parent into the other, bins that hold a piece twice are
taken apart, and their displaced pieces go back by best fit, largest first. A mutation takes the worst bins apart. Fitness
is few bins, then the mean square of the fills. After each epoch the elite of an island moves to the next one
of its shard; a shard whose best reaches the bound of its total length stops.

What shards leave unfilled is collected: each gives up its least filled bins, a ``1 / AGAIN`` share, whose pieces are
dealt to fewer shards and packed anew, level by level until one shard is left. So the work of all
further levels is a fraction of the first one's, and no task sees more than a shard.

Edge cases: a null text is empty and has the end id only. Null and repeated ids are documents of their own. Full
pieces are sequences by themselves. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import records
from . import words as W
from .store import keep, remove

CAPACITY = 4096
SHARD = 2048
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
CHILDREN = 12
"""Children that an island has in an epoch."""
WELL_FILLED = 0.98
AGAIN = 16
_SLICE = 1_000_000

Bins = list[list[int]]


def pieces(
    docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``row, doc_id, piece, start, length, ids_crc32`` of all documents; ``row`` is unique when stored."""
    named = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, row = records.encoder(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                ids, bounds = code.encode(part.column("text"), end)
                raw = memoryview(ids.astype("<u4").tobytes())
                n = -(-np.diff(bounds) // capacity)
                of = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                begin = bounds[:-1][of] + piece * capacity
                stop = np.minimum(begin + capacity, bounds[1:][of])
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), stop.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array(row + np.arange(len(of))),
                        "doc_id": part.column("doc_id").take(pa.array(of)),
                        "piece": pa.array(piece.astype(np.int32)),
                        "start": pa.array(piece * capacity),
                        "length": pa.array(stop - begin),
                        "ids_crc32": pa.array(sums, pa.int64()),
                    }
                )
                row += len(of)

    made = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return named.mapInArrow(run, made)


class Room:
    """Bins with free space, found by best fit in constant time: a bit for every free space that occurs."""

    def __init__(self, sizes: list[int], capacity: int, bins: Bins):
        self.sizes, self.capacity, self.bins = sizes, capacity, bins
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0
        for b, items in enumerate(bins):
            self._offer(capacity - sum(sizes[i] for i in items), b)

    def _offer(self, space: int, b: int) -> None:
        if space:
            self.free[space].append(b)
            self.mask |= 1 << space

    def put(self, items: list[int]) -> None:
        """Every item, largest first, into the bin it fits best, or a new one."""
        sizes = self.sizes
        for i in sorted(items, key=lambda i: -sizes[i]):
            size = sizes[i]
            fitting = self.mask >> size
            if fitting:
                space = size + (fitting & -fitting).bit_length() - 1
                b = self.free[space].pop()
                if not self.free[space]:
                    self.mask &= ~(1 << space)
                self.bins[b].append(i)
            else:
                space, b = self.capacity, len(self.bins)
                self.bins.append([i])
            self._offer(space - size, b)


def fitness(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Lower is better: the number of bins, then how little their fills differ from full and empty."""
    fills = [sum(sizes[i] for i in b) / capacity for b in bins]
    return len(bins), -sum(f * f for f in fills) / max(1, len(bins))


def best_fit(sizes: list[int], capacity: int, order: list[int] | None = None) -> Bins:
    """Best fit of all items: decreasing, or one after the other in the order given."""
    room = Room(sizes, capacity, [])
    for part in [list(range(len(sizes)))] if order is None else [order[k : k + 8] for k in range(0, len(order), 8)]:
        room.put(part)
    return room.bins


def crossover(into: Bins, other: Bins, sizes: list[int], capacity: int, rng: Random) -> Bins:
    """``into`` with some of the well-filled bins of ``other``; displaced items go back by best fit."""
    filled = sorted(other, key=lambda b: -sum(sizes[i] for i in b))
    good = [b for b in filled if sum(sizes[i] for i in b) >= WELL_FILLED * capacity] or filled[:1]
    injected = rng.sample(good, max(1, len(good) // 2))
    inside = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in into:
        if inside.isdisjoint(b):
            kept.append(list(b))
        else:
            displaced += [i for i in b if i not in inside]
    room = Room(sizes, capacity, [list(b) for b in injected] + kept)
    room.put(displaced)
    return room.bins


def mutated(bins: Bins, sizes: list[int], capacity: int, rng: Random) -> Bins:
    """The least filled bins and some others taken apart and packed again."""
    order = sorted(range(len(bins)), key=lambda b: sum(sizes[i] for i in bins[b]))
    n = max(2, len(bins) // 32)
    out = set(order[:n]) | set(rng.sample(order, min(n, len(order))))
    room = Room(sizes, capacity, [list(b) for k, b in enumerate(bins) if k not in out])
    room.put([i for k in out for i in bins[k]])
    return room.bins


def evolved(sizes: list[int], capacity: int, elites: list[Bins], seed: int) -> Bins:
    """The best grouping of one island after an epoch; the elites given are part of its population."""
    bound = -(-sum(sizes) // capacity)
    rate = lambda b: fitness(b, sizes, capacity)
    people = [best_fit(sizes, capacity)] if not elites else list(elites)
    best = min(people, key=rate)
    if len(best) <= bound:
        return best
    rng = Random(seed)
    while len(people) < POPULATION:
        near = sorted(range(len(sizes)), key=lambda i: -sizes[i] * rng.uniform(0.8, 1.0))
        people.append(best_fit(sizes, capacity, near))
    ranked = sorted(((rate(p), k, p) for k, p in enumerate(people)), key=lambda x: x[:2])
    for child in range(CHILDREN):
        a, b = rng.sample(ranked[: max(2, POPULATION // 2)], 2)
        made = crossover(a[2], b[2], sizes, capacity, rng)
        if child % 2:
            made = mutated(made, sizes, capacity, rng)
        ranked.append((rate(made), POPULATION + child, made))
        ranked.sort(key=lambda x: x[:2])
        ranked.pop()
        if ranked[0][0][0] <= bound:
            break
    return ranked[0][2]


def _labels(bins: Bins, n: int) -> list[int]:
    label = [0] * n
    for b, items in enumerate(bins):
        for i in items:
            label[i] = b
    return label


def _bins(label: list[int]) -> Bins:
    bins: Bins = [[] for _ in range(max(label, default=-1) + 1)]
    for i, b in enumerate(label):
        bins[b].append(i)
    return bins


def pack(lengths: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """``row, sequence_id, offset`` of ``row, length``; rows are unique and stored."""
    spark = lengths.sparkSession
    full = lengths.filter(F.col("length") >= capacity)
    done = full.select("row", F.col("row").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    left, level = lengths.filter(F.col("length") < capacity), 1
    while True:
        n = left.count()
        if not n:
            return done
        shards = -(-n // shard)
        dealt = F.pmod(F.xxhash64(F.lit(level), "row"), F.lit(shards)).alias("shard")
        # a hash of unique rows: shards are about equal, whatever the lengths
        groups, groups_at = keep(
            left.select(dealt, F.struct("row", "length").alias("item"))
            .groupBy("shard")
            .agg(F.sort_array(F.collect_list("item")).alias("items"))
            .select("shard", F.col("items.row").alias("rows"), F.col("items.length").alias("lengths")),
            "shards",
        )
        best, best_at = _evolve(groups, shards, capacity, level)
        placed, _ = keep(_placed(best, capacity, level, again=shards > 1), "packed")
        remove(spark, groups_at, best_at)
        done = done.union(placed.filter("not again").select("row", "sequence_id", "offset"))
        if shards == 1:
            return done
        left, level = placed.filter("again").select("row", "length"), level + 1


def _evolve(groups: DataFrame, shards: int, capacity: int, level: int) -> tuple[DataFrame, str]:
    """The best grouping of every shard after all epochs, as ``rows, lengths, label``; stored."""
    spark = groups.sparkSession
    tasks = max(1, min(shards * ISLANDS, 100_000))
    islands = groups.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.array().cast("array<array<int>>").alias("elites"),
    )
    made = "shard bigint, island int, rows array<bigint>, lengths array<bigint>, label array<int>, bins bigint, score double"

    def epoch(number: int):  # noqa: ANN202
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(batch.num_rows):
                    one = batch.slice(at, 1)
                    r = one.select(["shard", "island", "lengths", "elites"]).to_pylist()[0]
                    seed = hash((level, r["shard"], r["island"], number))
                    bins = evolved(r["lengths"], capacity, [_bins(e) for e in r["elites"]], seed)
                    few, score = fitness(bins, r["lengths"], capacity)
                    yield pa.RecordBatch.from_arrays(
                        [one.column("shard"), one.column("island"), one.column("rows"), one.column("lengths"),
                         pa.array([_labels(bins, len(r["lengths"]))], pa.list_(pa.int32())),
                         pa.array([few], pa.int64()), pa.array([score], pa.float64())],
                        names=["shard", "island", "rows", "lengths", "label", "bins", "score"],
                    )

        return run

    path = None
    for number in range(EPOCHS):
        dealt = islands.repartition(tasks, "shard", "island")
        lived, new_path = keep(dealt.mapInArrow(epoch(number), made), "islands")
        if path is not None:
            remove(spark, path)
        path = new_path
        guests = lived.select(
            "shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("label").alias("guest")
        )
        islands = lived.join(guests, ["shard", "island"]).select(
            "shard", "rows", "lengths", "island", F.array("label", "guest").alias("elites")
        )
    found = F.struct("rows", "lengths", "label")
    best = lived.groupBy("shard").agg(F.min_by(found, F.struct("bins", "score", "island")).alias("best"))
    kept, best_at = keep(best.select("shard", "best.*"), "groupings")
    remove(spark, path)
    return kept, best_at


def _placed(best: DataFrame, capacity: int, level: int, again: bool) -> DataFrame:
    """``row, length, sequence_id, offset, again`` of every piece; ``again`` marks those of the worst bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                sizes, bins = r["lengths"], _bins(r["label"])
                fills = [sum(sizes[i] for i in b) for b in bins]
                worst = sorted(range(len(bins)), key=lambda b: fills[b])[: -(-len(bins) // AGAIN)]
                give = {b for b in worst if fills[b] < capacity} if again else set()
                made = []
                for b, items in enumerate(bins):
                    at = 0
                    for i in items:
                        made.append((r["rows"][i], sizes[i], level << 56 | r["shard"] << 24 | b, at, b in give))
                        at += sizes[i]
                names = ["row", "length", "sequence_id", "offset", "again"]
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*made, strict=True)), strict=True)))

    rows = "row bigint, length bigint, sequence_id bigint, offset bigint, again boolean"
    return best.mapInArrow(run, rows)


def packed(docs: DataFrame, tokenizer: str, end: int = 1, capacity: int = CAPACITY, **columns: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    cut, _ = keep(pieces(docs, tokenizer, end, capacity, **columns), "pieces")
    return cut.join(pack(cut.select("row", "length"), capacity), "row").drop("row")
