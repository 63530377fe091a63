"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours.

A turn is known by the 128-bit hash of its role and text, a conversation by the hashes of its turns in
order. Conversations are range-sorted by them, so the members of every node of the trie lie side by side,
and the common prefix (LCP) of two neighbours is an edge between them. A task takes its edges in descending depth:
merging two components at depth d makes the branching node at d, and the stretch that a component rises between two merges
is its chain of nodes with one child. What contains the first or the last path of the task may go on in
the next one and stays open: the task's forest is contracted to these two paths, with what hangs off
them summed at each depth. Contracted forests of neighbouring tasks are paths in order again and are folded by
the same function, ``FAN`` at a time, until one is left; only then are its nodes closed.

Conversations are cut into blocks of ``BLOCK`` turns. Every block is a row of its own, sorted behind the hash of
all turns before it, so no row grows with a conversation; blocks are folded from the deepest to the
first, and the sums of a block's root go into the block before it. Most corpora have one block.
A turn's place is found by a range sort with running counts across ranges, so a conversation may hold a third of
all turns. A node's children learn the node's smallest member by a join when the node was open while they
were closed. The ids of conversations that end at a node are hashed as a stream of blocks of ids.

Edge cases: null roles and texts are empty; rows with a null conversation are left out. Turns of one number
come in the order of their hashes, wherever they are stored; repeated rows are turns of their own. An empty table
gives no node; a conversation without turns ends at the root. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import keep, remove

BLOCK = 4096
"""Turns of a conversation in one row."""
FAN = 32
"""Contracted forests that one task folds."""
CHUNK_ROWS = 20_000
CHUNK_BYTES = 8_000_000
IDS = 4096
"""Conversation ids that are joined before they are hashed."""

_CODE = 16
_ADD = (
    "struct<depth: bigint, n: bigint, leaves: bigint, saved: bigint, children: bigint,"
    " least: bigint, ender: bigint, tags: array<bigint>>"
)
_NODE, _OPEN, _NAMED, _ROOT = range(4)
_NUMBERS = (
    "conv_id", "depth", "parent", "wait", "n_convs", "n_children", "n_leaves", "saved", "ender",
)
_OUT = (
    "kind bigint, part bigint, seq bigint, "
    + "".join(f"{c} bigint, " for c in _NUMBERS)
    + f"s1 bigint, s2 bigint, key binary, words array<bigint>, tag bigint, adds array<{_ADD}>, tags array<bigint>"
)
_ADD_TYPE = pa.struct(
    [(n, pa.int64()) for n in ("depth", "n", "leaves", "saved", "children", "least", "ender")]
    + [("tags", pa.list_(pa.int64()))]
)
_OUT_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("kind", "part", "seq", *_NUMBERS, "s1", "s2")]
    + [("key", pa.binary()), ("words", pa.list_(pa.int64())), ("tag", pa.int64())]
    + [("adds", pa.list_(_ADD_TYPE)), ("tags", pa.list_(pa.int64()))]
)
_ITEM = ("s1", "s2", "key", "words", "tag", "adds")
_LEFT, _RIGHT = 1, 2


def steps(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id, pos, code, words``: each turn's place from 1, hash, and number of words; stored."""
    said, spoke = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    whole = F.concat(F.length(spoke).cast("string"), F.lit(":"), spoke, said)
    coded, coded_at = keep(
        turns.filter(F.col(conv_id).isNotNull()).select(
            F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
            F.unhex(F.md5(whole)).alias("code"),
            F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "coded",
    )
    order = ["turn", "code", "row"]
    ranged, ranged_at = keep(
        coded.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()), "ranged"
    )
    counts = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("conv_id", "part", F.sum("n").over(before).alias("ahead")).filter("ahead > 0")
    nth = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    placed, _ = keep(
        ranged.withColumn("nth", nth)
        .join(ahead, ["conv_id", "part"], "left")
        .select("conv_id", (F.col("nth") + F.coalesce("ahead", F.lit(0))).alias("pos"), "code", "words"),
        "placed",
    )
    remove(turns.sparkSession, coded_at, ranged_at)
    return placed


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", **columns: str) -> DataFrame:
    """The nodes of the trie over the conversations as they are."""
    placed = steps(turns, conv_id, **columns)
    return nodes(placed.withColumnRenamed("pos", "depth"), placed.select("conv_id").distinct())


def nodes(placed: DataFrame, members: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """The nodes over ``conv_id, depth, code, words``; ``members`` names every conversation once."""
    spark = placed.sparkSession
    paths, paths_at = keep(_paths(placed, members, block), "paths")
    deepest = paths.agg(F.max("block")).first()[0]
    turns = F.size("words") + F.col("block") * block
    ends, _ = keep(_ends(paths.filter("ends").withColumn("n", turns)), "ends")
    found, carried = [], None
    for b in range(deepest if deepest is not None else -1, -1, -1):
        rows = paths.filter(F.col("block") == b)
        if carried is None:
            sums = [F.lit(None).cast("bigint").alias(c) for c in ("n_leaves", "saved", "n_children")]
            rows = rows.select("*", *sums, F.lit(None).cast("array<bigint>").alias("tags"))
        else:
            sums = carried.select("conv_id", "n_leaves", "saved", "n_children", "tags")
            rows = rows.join(sums, "conv_id", "left")
        grown = _grown(_items(rows), b * block, fan)
        found.append(grown.filter(F.col("kind").isin(_NODE, _NAMED)))
        carried = grown.filter(F.col("kind") == _ROOT)
    remove(spark, paths_at)
    columns = [
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"),
    ]
    nothing = hashlib.sha256(b"").hexdigest()
    if not found:
        empty = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        return spark.createDataFrame(
            [], empty + "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
        )
    grown = found[0]
    for more in found[1:]:
        grown = grown.union(more)
    named = grown.filter(F.col("kind") == _NAMED).select("wait", "depth", F.col("conv_id").alias("name"))
    made = grown.filter(F.col("kind") == _NODE).select(*_NUMBERS)
    waiting = (
        made.filter("wait is not null")
        .withColumn("above", F.col("depth") - 1)
        .join(named.withColumnRenamed("depth", "above"), ["wait", "above"], "left")
        .withColumn("parent", F.col("name"))
        .select(*_NUMBERS)
    )
    whole = made.filter("wait is null").union(waiting)
    passed = whole.filter("ender is null").select(*columns, F.lit(nothing).alias("ends_sha256"))
    ended = whole.filter("ender is not null").join(ends, "ender").select(*columns, "ends_sha256")
    return passed.union(ended)


def _paths(placed: DataFrame, members: DataFrame, block: int) -> DataFrame:
    """A row per conversation and block: hash of the turns before, hashes and words of its turns."""
    code = ["depth", "code"]
    turns = placed.select(
        "conv_id", ((F.col("depth") - 1) / block).cast("bigint").alias("block"),
        F.struct("depth", "code", "words").alias("turn"),
        F.xxhash64(*code).alias("x1"), F.xxhash64(F.lit(17), *code).alias("x2"),
    )
    turnless = members.select("conv_id", F.lit(0).cast("bigint").alias("block"))
    cut = (
        turns.unionByName(turnless, allowMissingColumns=True)
        .groupBy("conv_id", "block")
        .agg(
            F.sort_array(F.collect_list("turn")).alias("turns"),
            F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
        )
    )
    order = Window.partitionBy("conv_id").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nil = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return cut.select(
        "conv_id", "block",
        *[nil(F.bit_xor(f"x{i}").over(before)).alias(f"s{i}") for i in (1, 2)],
        *[nil(F.bit_xor(f"x{i}").over(so_far)).alias(f"e{i}") for i in (1, 2)],
        F.lead("block").over(order).isNull().alias("ends"),
        F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["code"])), "")).alias("key"),
        F.transform("turns", lambda t: t["words"]).alias("words"),
    )


def _items(rows: DataFrame) -> DataFrame:
    """Blocks as paths with one member each; sums of the next block's root go to its smallest member."""
    carries = F.col("n_leaves").isNotNull()
    nil = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    add = F.struct(
        F.size("words").cast("bigint").alias("depth"), F.lit(1).cast("bigint").alias("n"),
        nil("n_leaves").alias("leaves"), nil("saved").alias("saved"), nil("n_children").alias("children"),
        F.col("conv_id").alias("least"), F.when(F.col("ends"), F.col("conv_id")).alias("ender"),
        F.when(carries, F.array_distinct(F.concat(F.array("conv_id"), "tags")))
        .otherwise(F.array().cast("array<bigint>")).alias("tags"),
    )
    return rows.select("s1", "s2", "key", "words", F.col("conv_id").alias("tag"), F.array(add).alias("adds"))


def _grown(items: DataFrame, base: int, fan: int) -> DataFrame:
    """Nodes, names of open nodes and, below the first block, roots of all ``items``; stored."""
    order = ["s1", "s2", "key", "tag"]
    ranged = items.repartitionByRange(*order).sortWithinPartitions(*order)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, open_, size = TaskContext.get().partitionId(), [], [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                size += len(row["key"])
                if len(held) >= CHUNK_ROWS or size >= CHUNK_BYTES:
                    out = fold(open_ + held, base, closing=False)
                    yield from out.batches()
                    held, open_, size = [], out.paths, 0
        if held or open_:
            out = fold(open_ + held, base, closing=False)
            yield from out.batches()
            yield from out.open_batch(part)

    level, _ = keep(ranged.mapInArrow(first, _OUT), "forests")
    done = level.filter(F.col("kind") != _OPEN)
    while True:
        open_ = level.filter(F.col("kind") == _OPEN)
        last = open_.agg(F.max("part")).first()[0]
        if last is None:
            return done
        groups = open_.groupBy((F.col("part") / fan).cast("bigint"))
        level, _ = keep(groups.applyInArrow(_merger(base, fan, last < fan), _OUT), "forests")
        done = done.union(level.filter(F.col("kind") != _OPEN))


def _merger(base: int, fan: int, closing: bool) -> Callable[[pa.Table], pa.Table]:
    """Folds the open paths of ``fan`` neighbouring parts."""

    def merge(rows: pa.Table) -> pa.Table:
        group = rows.column("part")[0].as_py() // fan
        ordered = rows.sort_by([("part", "ascending"), ("seq", "ascending")])
        out = fold(ordered.select(list(_ITEM)).to_pylist(), base, closing)
        return pa.Table.from_batches([*out.batches(), *out.open_batch(group)], _OUT_SCHEMA)

    return merge


@dataclass(slots=True)
class Part:
    """A component of the union-find: what is known of the node at ``depth`` on its path."""

    depth: int
    n: int = 0
    leaves: int = 0
    saved: int = 0
    children: int = 0
    least: int | None = None
    ender: int | None = None
    tags: list[int] = field(default_factory=list)
    row: int = 0
    side: int = 0
    waiting: list[list] = field(default_factory=list)

    def take(self, other: Part) -> None:
        """Adds a component of the same depth."""
        self.n += other.n
        self.leaves += other.leaves
        self.saved += other.saved
        self.children += other.children
        self.least = _lower(self.least, other.least)
        self.ender = _lower(self.ender, other.ender)
        self.tags += other.tags
        self.waiting += other.waiting
        both = [s for s in (self.side, other.side) if s]
        self.side = min(both) if both else 0


def _lower(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def shared(a: bytes, b: bytes) -> int:
    """Turns at the start of both."""
    high = min(len(a), len(b)) // _CODE
    if a[: high * _CODE] == b[: high * _CODE]:
        return high
    low = 0  # the first ``low`` turns are equal, the first ``high`` are not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * _CODE : mid * _CODE] == b[low * _CODE : mid * _CODE]:
            low = mid
        else:
            high = mid
    return low


class Folded:
    """What a fold gives: closed nodes, names of nodes left open before, roots, and open paths."""

    def __init__(self) -> None:
        self.nodes: list[list] = []
        self.named: list[tuple] = []
        self.roots: list[tuple] = []
        self.paths: list[dict] = []

    def batches(self) -> Iterator[pa.RecordBatch]:
        for kind, rows in ((_NODE, self.nodes), (_NAMED, self.named), (_ROOT, self.roots)):
            if rows:
                names = (*_NUMBERS, "tags")[: len(rows[0])]
                yield _batch(kind, dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)), len(rows))

    def open_batch(self, part: int) -> Iterator[pa.RecordBatch]:
        if self.paths:
            columns = {c: [p[c] for p in self.paths] for c in _ITEM}
            columns |= {"part": [part] * len(self.paths), "seq": list(range(len(self.paths)))}
            yield _batch(_OPEN, columns, len(self.paths))


def _batch(kind: int, columns: dict[str, list], n: int) -> pa.RecordBatch:
    columns = columns | {"kind": [kind] * n}
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _OUT_SCHEMA
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=_OUT_SCHEMA)


def fold(items: list[dict], base: int, closing: bool) -> Folded:
    """Grows the trie over sorted paths; with ``closing`` nothing lies beyond them.

    A path's ``adds`` say, by ascending depth, what belongs to its node there and to none deeper on it;
    the last one is at the path's end. ``base`` is the depth at which all paths begin.
    """
    out = Folded()
    last = len(items) - 1
    parts: list[Part] = []
    edges: list[tuple[int, int, int]] = []
    begin: list[int] = []  # first component of each path
    for r, item in enumerate(items):
        side = 0 if closing else _LEFT if r == 0 else _RIGHT if r == last else 0
        begin.append(len(parts))
        for add in item["adds"]:
            if len(parts) > begin[r]:
                edges.append((parts[-1].depth, len(parts) - 1, len(parts)))
            parts.append(Part(**add, row=r, side=side))
        before = items[r - 1]
        if r and (before["s1"], before["s2"]) == (item["s1"], item["s2"]):
            depth = shared(before["key"], item["key"])
            at = lambda k: next(p for p in range(begin[k], len(parts)) if parts[p].depth >= depth)  # noqa: E731, B023
            edges.append((depth, at(r - 1), at(r)))
    above = list(range(len(parts)))

    def find(p: int) -> int:
        while above[p] != p:
            above[p] = above[above[p]]
            p = above[p]
        return p

    history: dict[int, list[dict]] = {_LEFT: [], _RIGHT: []}
    tag = {_LEFT: items[0]["tag"], _RIGHT: items[last]["tag"]} if items else {}

    def leave_open(part: Part) -> None:
        """Stores what hangs off an open path at this depth; its closed children wait for its name."""
        for node in part.waiting:
            node[3] = tag[part.side]
        own = [tag[part.side]] if part.waiting and tag[part.side] not in part.tags else []
        tags = part.tags + own
        if part.n or tags:
            history[part.side].append(
                {"depth": part.depth, "n": part.n, "leaves": part.leaves, "saved": part.saved,
                 "children": part.children, "least": part.least, "ender": part.ender, "tags": tags}
            )

    def close(part: Part) -> None:
        for node in part.waiting:
            node[2] = part.least
        out.named.extend((part.least, base + part.depth, None, t, *[None] * 5) for t in part.tags)

    def rise(part: Part, depth: int) -> Part:
        """The component at a smaller depth, all nodes in between closed or left open."""
        if part.depth == depth:
            return part
        if part.side:
            leave_open(part)
            return Part(depth, row=part.row, side=part.side)
        close(part)
        words = items[part.row]["words"]
        leaves, saved, children, ender = part.leaves or 1, part.saved, part.children, part.ender
        for d in range(part.depth, depth, -1):
            saved += (part.n - 1) * words[d - 1]
            node = [part.least, base + d, part.least, None, part.n, children, leaves, saved, ender]
            out.nodes.append(node)
            children, ender = 1, None
        node[2] = None
        return Part(depth, part.n, leaves, saved, 1, part.least, None, [], part.row, 0, [node])

    edges.sort(key=lambda e: -e[0])
    for depth, a, b in edges:
        a, b = find(a), find(b)
        parts[a] = rise(parts[a], depth)
        parts[a].take(rise(parts[b], depth))
        above[b] = a
    for p in [p for p in range(len(parts)) if above[p] == p]:
        root = rise(parts[p], 0)
        if root.side:
            leave_open(root)
            continue
        leaves = root.leaves or 1
        if base:
            # the node is the end of the block before, which knows its smallest member
            for node in root.waiting:
                node[3] = root.least
            sums = (root.n, root.children, leaves, root.saved)
            out.roots.append((root.least, base, None, None, *sums, None, root.tags))
        else:
            close(root)
            out.nodes.append([root.least, 0, None, None, root.n, root.children, leaves, root.saved, root.ender])
    for side, r in ((_LEFT, 0), (_RIGHT, last)):
        if history[side]:
            out.paths.append({c: items[r][c] for c in _ITEM} | {"adds": history[side][::-1]})
    return out


def _ends(paths: DataFrame) -> DataFrame:
    """``ender, ends_sha256``: of all conversations with equal turns the smallest id, and the hash of their ids.

    The ids are sorted over all tasks and joined to blocks; only the blocks of one group meet.
    """
    group = ["e1", "e2", "n"]
    ids = paths.select(*group, "conv_id")
    ids = ids.repartitionByRange(*group, "conv_id").sortWithinPartitions(*group, "conv_id")
    columns = [*group, "conv_id"]

    def rows_of(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(c).to_pylist() for c in names], strict=True)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        for key, rows in groupby(rows_of(batches, columns), lambda r: r[:3]):
            held: list[int] = []
            for r in rows:
                held.append(r[3])
                if len(held) == IDS:
                    made.append((*key, held[0], ",".join(map(str, held))))
                    held = []
            if held:
                made.append((*key, held[0], ",".join(map(str, held))))
            if len(made) >= 1000:
                yield _columns(made, [*columns, "ids"])
                made = []
        if made:
            yield _columns(made, [*columns, "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        for _, rows in groupby(rows_of(batches, [*columns, "ids"]), lambda r: r[:3]):
            sha, first = hashlib.sha256(), None
            for r in rows:
                sha.update(("," if first is not None else "").encode() + r[4].encode())
                first = r[3] if first is None else first
            made.append((first, sha.hexdigest()))
            if len(made) >= 10_000:
                yield _columns(made, ["ender", "ends_sha256"])
                made = []
        if made:
            yield _columns(made, ["ender", "ends_sha256"])

    blocks = ids.mapInArrow(join, "e1 bigint, e2 bigint, n bigint, conv_id bigint, ids string")
    gathered = blocks.repartition(*group).sortWithinPartitions(*group, "conv_id")
    return gathered.mapInArrow(digest, "ender bigint, ends_sha256 string")


def _columns(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))
