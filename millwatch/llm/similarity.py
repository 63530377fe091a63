"""Jaccard join of documents by parity sketches.

A document is the set of its distinct word shingles. Two documents link when their sets have a
Jaccard similarity of at least ``percent`` / 100. For sets of sizes ``m`` and ``n`` that bounds the
symmetric difference by ``(m + n) * (100 - percent) / (100 + percent)``.

*Sketch.* Shingles are dealt to blocks by hash, and the hashes in a block are XORed. A shingle that
only one of two sets has changes one block, so the number of differing blocks is at most the
symmetric difference ``d``: of ``d + 1`` or more blocks at least one is equal (pigeonhole). A second
sketch of one bit per shingle gives a Hamming distance that is a lower bound of the symmetric
difference too; it discards candidates before any set is read.

*Bands.* Sizes are cut into bands, each reaching 1 / similarity times as far as the one before, so
that linked documents lie in one band or in neighbours. A document registers in its own band
and, as a lower guest, in the next; ``d`` and the number of blocks belong to the band.

*Exactness.* Equal empty blocks say nothing and are not joined. A document is safe in a band if more
than ``d`` of its blocks can be joined on: then any partner shares one of them. Documents that are not
safe register again under other block assignments until they are, in the end with their empty
blocks. Of its blocks a document is joined only on the rarest, blocks that nobody shares counting
as such; the blocks of a passage that very many documents share are the last resort.

*No pairs within a group.* Documents with equal sets are one class, joined once. In every bucket the
members are compared with one leader, links are merged into components, buckets that lie in one
component are done, and what is left is compared with further leaders, at last pairwise between
different components only. So no link between components is missed, and a group of thousands of
near copies costs a few comparisons per document.

Edge cases: null texts and texts without words have an empty set and link with nothing. Texts
with fewer than five words are one shingle. Repeated rows form a class; rows with one id but
different texts are joined separately. A null id never becomes a component's id unless all are null.
Empty tables give no rows. Columns besides the two named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .graph import components
from .store import keep, release, remove

PERCENT = 80
SKETCH_BITS = 1024
LEADER_ROUNDS = 2
FILTER_BITS = 1 << 26
"""Bits of the filter that limits which texts are read again; more members only make it read more."""
_SALTS = 24

CLASSES = (
    "doc_id bigint, n_shingles bigint, cls bigint, band int, slack_own int, slack_low int, "
    "sketch array<bigint>"
)
KEYS = "key bigint, member bigint"
SETS = "cls bigint, shingles array<bigint>"


@cache
def bands(percent: int, most: int) -> np.ndarray:
    """Largest size of every band, up to one that holds ``most``."""
    tops = [1]
    while tops[-1] < most:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // percent))
    return np.array(tops, np.int64)


def band_of(n: int, percent: int) -> int:
    return int(np.searchsorted(bands(percent, 1 << 40), n))


def allowed(band: int, percent: int) -> int:
    """Largest symmetric difference of a linked pair in the band."""
    return int(2 * int(bands(percent, 1 << 40)[band]) * (100 - percent) // (100 + percent))


def n_blocks(d: int) -> int:
    """More than ``d + 1``, so that some blocks may be empty or shared by many."""
    return d + 2 + d // 6


def class_of(values: np.ndarray) -> int:
    """A 63-bit name of the set."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(W.mix(values + np.uint64(0x51ED27))) + np.uint64(len(values))
    return int(W.mix(total[None])[0] >> np.uint64(1))


def block_sketch(values: np.ndarray, band: int, d: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and XORs of the blocks that hold shingles."""
    if salt:
        values = np.sort(W.mix(values ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)))
    block = ((values >> np.uint64(33)) * np.uint64(n_blocks(d))) >> np.uint64(31)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    return block[first], np.bitwise_xor.reduceat(W.mix(values), first)


def spare_blocks(values: np.ndarray, band: int, percent: int) -> int:
    """How many of its first assignment's blocks a set can do without; -1 if it lacks some."""
    d = allowed(band, percent)
    return max(-1, len(block_sketch(values, band, d, 0)[0]) - (d + 1))


def bucket_keys(values: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Join keys of a set in a band, with the band in their low byte."""
    d = allowed(band, percent)
    if d == 0:  # only equal sets link here
        return np.zeros(0, np.uint64)
    keys = []
    for salt in range(_SALTS):
        number, value = block_sketch(values, band, d, salt)
        place = np.uint64((band << 8 | salt) << 40) + number
        keys.append(W.mix(value ^ W.mix(place)))
        if len(number) > d:
            break
    else:
        empty = np.setdiff1d(np.arange(n_blocks(d), dtype=np.uint64), number)
        keys.append(W.mix(W.mix(np.uint64((band << 8 | salt) << 40) + empty)))
    found = np.concatenate(keys)
    return (found & ~np.uint64(0xFF)) | np.uint64(band)


def parity_sketch(values: np.ndarray) -> np.ndarray:
    """``SKETCH_BITS`` parities: every shingle flips one bit."""
    odd = np.bincount((values & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    values, bounds = W.shingles(W.split(column))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield np.unique(values[a:b])


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )


def set_classes(named: DataFrame, percent: int) -> DataFrame:
    """One row per document: size, class, and what the candidate search needs of the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                rows = []
                for values in _sets(part.column("text")):
                    n = len(values)
                    if not n:
                        rows.append((0, None, None, None, None, None))
                        continue
                    band = band_of(n, percent)
                    own = spare_blocks(values, band, percent)
                    low = spare_blocks(values, band + 1, percent)
                    rows.append((n, class_of(values), band, own, low, parity_sketch(values)))
                n, cls, band, own, low, sketch = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                        pa.array(band, pa.int32()), pa.array(own, pa.int32()),
                        pa.array(low, pa.int32()), pa.array(sketch, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "cls", "band", "slack_own", "slack_low", "sketch"],
                )

    return named.mapInArrow(run, CLASSES)


def bucket_rows(named: DataFrame, percent: int) -> DataFrame:
    """``key, member``: a member is the class, with the sign bit set in its own band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                keys, members = [], []
                for values in _sets(part.column("text")):
                    if not len(values):
                        continue
                    band, cls = band_of(len(values), percent), class_of(values)
                    for at, member in ((band, cls - 2**63), (band + 1, cls)):
                        found = bucket_keys(values, at, percent)
                        keys.append(found)
                        members.append(np.full(len(found), member, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(members))],
                        names=["key", "member"],
                    )

    return named.mapInArrow(run, KEYS)


def shared_buckets(rows: DataFrame) -> DataFrame:
    """``key, cls, own`` of the buckets in which a class of the band meets another class.

    Reads the rows sorted by bucket as a stream: no bucket is held in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_member = first_member = None
        told = False  # whether the first row of the current bucket has been passed on
        for batch in batches:
            key = batch.column("key").to_numpy()
            member = batch.column("member").to_numpy()
            if not len(key):
                continue
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
            if last_key is not None:
                fresh[0] = key[0] != last_key or member[0] != last_member
            last_key_now, last_member_now = int(key[-1]), int(member[-1])
            key, member = key[fresh], member[fresh]
            if not len(key):
                continue
            starts = np.ones(len(key), bool)
            starts[1:] = key[1:] != key[:-1]
            goes_on = last_key is not None and int(key[0]) == last_key
            starts[0] = not goes_on
            at = np.flatnonzero(starts)
            run_of = np.cumsum(starts) - 1  # -1: the bucket carried over
            sizes = np.bincount(run_of + 1, minlength=len(at) + 1)
            # a bucket's first row is an own one if it has any
            own_first = np.concatenate([[first_member is not None and first_member < 0], member[at] < 0])
            many = sizes > 1
            many[0] = sizes[0] > 0
            send = (many & own_first)[run_of + 1]
            out_key, out_member = key[send], member[send]
            if goes_on and sizes[0] and own_first[0] and not told:
                out_key = np.concatenate([[last_key], out_key])
                out_member = np.concatenate([[first_member], out_member])
            if len(at):
                first_member = int(member[at[-1]])
                told = bool(sizes[-1] > 1)
            elif sizes[0]:
                told = True
            last_key, last_member = last_key_now, last_member_now
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out_key.astype(np.int64)),
                    pa.array(out_member.astype(np.int64) & np.int64(2**63 - 1)),
                    pa.array(out_member < 0),
                ],
                names=["key", "cls", "own"],
            )

    dealt = rows.repartition("key").sortWithinPartitions("key", "member")
    return dealt.mapInArrow(run, "key bigint, cls bigint, own boolean")


def rarest(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Keeps the rows of each class's rarest blocks, as many as exactness needs.

    Blocks are features: linked sets share all but ``d`` of them, so under one order of all blocks
    they share one of the first ``d + 1`` of each (prefix filter). The order is by members, and
    blocks that nobody shares come first without being stored; a class can do without as many
    of its most popular blocks as it has to spare.
    """
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    spare = F.when(F.col("own"), F.col("slack_own")).otherwise(F.col("slack_low"))
    most_popular_first = Window.partitionBy("cls", "own").orderBy(F.desc("m"), F.desc("key"))
    return (
        members.join(sizes, "key")
        .join(classes.select("cls", "slack_own", "slack_low"), "cls")
        .withColumn("place", F.row_number().over(most_popular_first))
        .filter(F.col("place") > spare)
        .select("key", "cls", "own")
    )


def _hamming(a: str, b: str) -> Column:
    distance = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(distance, F.lit(0), lambda s, x: s + x)


def _fits(percent: int) -> Column:
    """Whether sizes and sketches of both sides allow a link."""
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    near = _hamming("s_a", "s_b") * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)
    return F.when(sizes, near).otherwise(F.lit(False))


def _side(classes: DataFrame, name: str) -> DataFrame:
    return classes.select(
        F.col("cls").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"s_{name}")
    )


def plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that sizes and sketches allow to link, with the sizes."""
    both = pairs.join(_side(classes, "a"), "a").join(_side(classes, "b"), "b")
    return both.filter(_fits(percent)).select("a", "b", "n_a", "n_b")


def across(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs of different components in one bucket; others never leave the join."""
    one = members.select("key", F.col("cls").alias("a"), F.col("own").alias("own_a"), F.col("comp").alias("c_a"))
    two = members.select("key", F.col("cls").alias("b"), F.col("own").alias("own_b"), F.col("comp").alias("c_b"))
    one, two = one.join(_side(classes, "a"), "a"), two.join(_side(classes, "b"), "b")
    meets = (
        (one["key"] == two["key"])
        & (F.col("a") < F.col("b"))
        & (F.col("c_a") != F.col("c_b"))
        & (F.col("own_a") | F.col("own_b"))
        & _fits(percent)
    )
    return one.join(two, meets).select("a", "b", "n_a", "n_b").distinct()


def _filter_of(ids: DataFrame) -> bytes:
    """A bitmap of hashed ids: its size is fixed, whatever their number."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)) + 1  # Spark counts bits from 1
    parts = (
        ids.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
        .collect()
    )
    size = len(parts[0]["bits"]) if parts else 0
    bits = bytearray(FILTER_BITS // 8 + size)
    for row in parts:
        low = (row["bucket"] - 1) * size
        bits[low : low + size] = row["bits"]
    return bytes(bits)


def read_sets(named: DataFrame, ids: DataFrame) -> DataFrame:
    """Shingle sets of the documents with these ids (and of few others), by reading texts again."""
    bitmap = named.sparkSession.sparkContext.broadcast(_filter_of(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                rows = [(class_of(v), v.view(np.int64)) for v in _sets(part.column("text")) if len(v)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for c, _ in rows], pa.int64()),
                        pa.array([v for _, v in rows], pa.list_(pa.int64())),
                    ],
                    names=["cls", "shingles"],
                )

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            at = batch.column("at").to_numpy()
            yield batch.filter(pa.array((bits[at >> 3] >> (at & 7)) & 1 == 1)).select(["text"])

    placed = named.select("text", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("at"))
    return placed.mapInArrow(lambda it: run(wanted(it)), SETS)


def verified(named: DataFrame, pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets really are that similar."""
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    ids = classes.join(ends, "cls", "left_semi").select("doc_id")
    # one exchange by class serves both sides
    sets = read_sets(named, ids).groupBy("cls").agg(F.first("shingles").alias("shingles"))
    a = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("s_a"))
    b = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("s_b"))
    shared = F.size(F.array_intersect("s_a", "s_b"))
    same = pairs.join(a, "a").join(b, "b").withColumn("shared", shared)
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return keep(same.filter(F.col("shared") * 100 >= union * percent).select("a", "b"), "links")[0]


def _star(members: DataFrame, turn: int) -> DataFrame:
    """Every member with its bucket's leader; at first only with the leader it meets most often."""
    order = F.when(F.col("own"), F.struct(F.xxhash64(F.lit(turn), "cls").alias("o"), F.col("cls")))
    lead = members.groupBy("key").agg(F.min(order).alias("lead")).filter(F.col("lead").isNotNull())
    pairs = members.join(lead, "key").select(F.col("cls").alias("x"), F.col("lead.cls").alias("y"))
    pairs = pairs.filter("x <> y").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    if turn == 0:
        pairs = pairs.groupBy("x").agg(F.max_by("y", F.struct("n", "y")).alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _open_buckets(members: DataFrame, label: DataFrame) -> DataFrame:
    """Rows of the buckets that still hold several components."""
    tagged = members.drop("comp").join(label.withColumnRenamed("node", "cls"), "cls", "left")
    tagged = tagged.select("key", "cls", "own", F.coalesce("comp", "cls").alias("comp"))
    several = tagged.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    return tagged.join(several.filter("lo <> hi").select("key"), "key", "left_semi")


def jaccard_links(
    named: DataFrame, classes: DataFrame, percent: int, paths: list[str]
) -> DataFrame:
    """Links ``a, b`` between classes that span every component."""
    spark = named.sparkSession
    members, raw = keep(shared_buckets(bucket_rows(named, percent)), "buckets")
    release(spark)
    members, path = keep(rarest(members, classes), "members")
    remove(spark, raw)
    paths.append(path)
    links = spark.createDataFrame([], "a bigint, b bigint")
    label = spark.createDataFrame([], "node bigint, comp bigint")
    tried = spark.createDataFrame([], "a bigint, b bigint")
    for turn in range(LEADER_ROUNDS + 1):
        if turn < LEADER_ROUNDS:
            pairs = plausible(_star(members, turn), classes, percent)
        else:
            pairs = across(members, classes, percent)
        pairs, path = keep(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        paths.append(path)
        if not pairs.isEmpty():
            tried = tried.union(pairs.select("a", "b"))
            links = links.union(verified(named, pairs, classes, percent))
            label = components(links)
        if turn < LEADER_ROUNDS:
            members, path = keep(_open_buckets(members, label), "members")
            paths.append(path)
        release(spark)
    return links


def similar_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class_id, component_id``.

    ``class_id`` is the smallest id among documents with the same set, ``component_id`` the smallest
    one reachable by links. Documents with an empty set are alone.
    """
    spark = docs.sparkSession
    named = _named(docs, doc_id, text)
    each, _ = keep(set_classes(named, percent), "classes")
    classes = each.filter("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
        F.first("slack_own").alias("slack_own"), F.first("slack_low").alias("slack_low"),
        F.first("sketch").alias("sketch"),
    )
    classes, class_path = keep(classes, "class")
    paths: list[str] = []
    links = jaccard_links(named, classes, percent, paths)
    label = components(links).withColumnRenamed("node", "cls")
    named_class = classes.select("cls", F.col("doc_id").alias("class_id")).join(label, "cls", "left")
    lowest = named_class.groupBy(F.coalesce("comp", "cls").alias("comp")).agg(
        F.min("class_id").alias("component_id")
    )
    full, _ = keep(
        named_class.withColumn("comp", F.coalesce("comp", "cls")).join(lowest, "comp")
        .select("cls", "class_id", "component_id"),
        "groups",
    )
    remove(spark, class_path, *paths)
    alone = each.filter("cls is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id")
    )
    grouped = each.filter("cls is not null").select("doc_id", "n_shingles", "cls").join(full, "cls")
    return grouped.select("doc_id", "n_shingles", "class_id", "component_id").union(alone)
