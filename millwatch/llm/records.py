"""Token ids as length-delimited binary records with an offset index.

A file is a run of records: the payload's length (8 bytes), the masked checksum of the length (4),
the payload, the masked checksum of the payload (4), all little-endian. The checksum is CRC-32,
masked as ``rotr(crc, 15) + 0xA282EAD8`` so that checksums of data that holds checksums stay
sound. A payload is the document's id (8 bytes), a byte with bit 0 set if the id is null, a byte
with the width of a token id (2 or 4), and the ids; an id takes two bytes when the vocabulary allows it.

Documents are sorted by a range exchange on their id, every range is encoded and written as one
file by one task, and the index (document, file, offset, length, tokens) is a table of its own. A
file is written under a name of its attempt and then renamed, so a repeated task replaces its
file by the same bytes. Files lie in the shared folder, through whatever filesystem its address names.

Edge cases: a null text is empty and has the end id only. A null id sorts before all others.
Rows with the same id are all written, in the order of their texts; equal rows give equal
records. An empty table gives an empty index and no file. Other columns are not looked at.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W

INDEX = "file string, seq bigint, doc_id bigint, offset bigint, length bigint, n_tokens bigint"
ROWS = "file string, seq bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
_FRAME = 16
_READ = 8_000_000
_SLICE = 1_000_000

Encoder = Callable[[], "WordEncoder"]


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    head = struct.pack("<qBB", doc_id or 0, doc_id is None, width)
    payload = head + ids.astype(f"<u{width}").tobytes()
    size = struct.pack("<Q", len(payload))
    return b"".join(
        [size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))]
    )


def unframe(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = struct.unpack_from("<qBB", payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=10)


def _checked(data: bytes, at: int, file: str) -> bytes:
    """The payload of the record that starts at ``at``; fails if a checksum is wrong."""
    size = data[at : at + 8]
    (n,) = struct.unpack("<Q", size)
    payload = data[at + 12 : at + 12 + n]
    sums = struct.unpack_from("<I", data, at + 8) + struct.unpack_from("<I", data, at + 12 + n)
    if sums != (masked(size), masked(payload)):
        raise ValueError(f"{file}: damaged record at {at}")
    return payload


_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = True
_LETTER[0x61:0x7B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]] = True


def _sure_breaks(data: np.ndarray) -> np.ndarray:
    """Bytes before which the tokenizer's pre-tokenizer always breaks.

    Between an ASCII letter and an ASCII mark other than the apostrophe, and around ASCII digits.
    """
    at = np.zeros(len(data), bool)
    letter, mark, digit = _LETTER[data], _MARK[data], _DIGIT[data]
    at[1:] = (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:]) | digit[1:] | digit[:-1]
    return at


class WordEncoder:
    """Encodes texts with a tokenizer that lower-cases and breaks at white space, marks and digits.

    A piece between such breaks is encoded once and then looked up by its 64-bit hash, which makes
    common words cheap. Slices in which a special token is spelt out are cut at white space only,
    in their own case. ``most`` bounds the pieces remembered at a time.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.lower().encode() for t in added]
        self.most = most
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int32)
        self.begin = np.zeros(1, np.int64)
        self.pieces = np.zeros(0, np.uint32)

    def learn(self, split: W.Words, hashes: np.ndarray, first: np.ndarray) -> None:
        raw = split.data.tobytes()
        texts = [
            raw[a:b].decode("utf-8")
            for a, b in zip(split.start[first].tolist(), split.stop[first].tolist(), strict=True)
        ]
        code = self.tokenizer.encode
        # one at a time: the tokenizer's result objects are large
        coded = [np.array(code(t, add_special_tokens=False).ids, np.uint32) for t in texts]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.concatenate(coded)
        slots = (len(self.begin) - 1 + np.arange(len(coded))).astype(np.int32)
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        self.pieces = np.concatenate([self.pieces, flat])
        # both are sorted: merging is an insertion
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.slot = np.insert(self.slot, at, slots)

    def encode(self, column: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and each row's range of them."""
        split = W.split(column, fold=True, cut=_sure_breaks)
        if b"<" in (whole := split.data.tobytes()) and any(t in whole.lower() for t in self.special):
            split = W.split(column, fold=False)
        hashes, first, which = np.unique(split.hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(hashes) > self.most:
            self.forget()
        at = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != hashes[inside]
        if new.any():
            self.learn(split, hashes[new], first[new])
        slot = self.slot[np.searchsorted(self.known, hashes)]
        begin, size = self.begin[slot], (self.begin[1:] - self.begin[:-1])[slot]
        sizes = size[which]
        ends = np.cumsum(sizes)
        source = np.arange(sizes.sum()) + np.repeat(begin[which] - (ends - sizes), sizes)
        ids = self.pieces[source]
        bounds = np.concatenate([[0], ends])[split.bounds]
        if end is not None:
            ids = np.insert(ids, bounds[1:], end)
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The tokenizer of this worker process; it keeps what it has learnt between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end: int | None = 2,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Writes all documents below ``folder`` and returns the plan of the offset index.

    The files are written when the index is: store it once and read that table.
    """
    named = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    ordered = named.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        width = 2 if code.vocabulary <= 65536 and (end or 0) < 65536 else 4
        where, base = fs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():08d}.rec"
        own = f"{base}/.{name}-{uuid.uuid4().hex}"
        out, offset, seq = None, 0, 0
        for batch in batches:
            for part in W.slices(batch, "text", _SLICE):
                if out is None:
                    where.create_dir(base, recursive=True)
                    out = where.open_output_stream(own)
                ids, bounds = code.encode(part.column("text"), end)
                names = part.column("doc_id").to_pylist()
                frames = [
                    frame(n, ids[a:b], width)
                    for n, a, b in zip(names, bounds[:-1], bounds[1:], strict=True)
                ]
                out.write(b"".join(frames))
                lengths = np.array([len(x) for x in frames], np.int64)
                starts = offset + np.cumsum(lengths) - lengths
                offset += int(lengths.sum())
                yield pa.RecordBatch.from_pydict(
                    {
                        "file": pa.array([name] * len(names), pa.string()),
                        "seq": pa.array(seq + np.arange(len(names))),
                        "doc_id": part.column("doc_id"),
                        "offset": pa.array(starts),
                        "length": pa.array(lengths),
                        "n_tokens": pa.array(np.diff(bounds)),
                    }
                )
                seq += len(names)
        if out is not None:
            out.close()
            where.move(own, f"{base}/{name}")

    return ordered.mapInArrow(run, INDEX)


def _records(where: fs.FileSystem, path: str) -> Iterator[bytes]:
    """Payloads of a file in order, read a bounded piece at a time."""
    with where.open_input_stream(path) as source:
        data, at = b"", 0
        while True:
            need = 12
            if len(data) - at >= 12:
                need = _FRAME + struct.unpack_from("<Q", data, at)[0]
            if len(data) - at < need:
                more = source.read(max(_READ, need - (len(data) - at)))
                if not more:
                    if len(data) > at:
                        raise ValueError(f"{path}: ends inside a record")
                    return
                data, at = data[at:] + more, 0
                continue
            yield _checked(data, at, path)
            at += need


def read(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the files that the stored index names, in file order, checksums verified.

    ``ids_crc32`` is the checksum of the ids as 32-bit little-endian numbers.
    """
    files = index.groupBy("file").agg(F.sum("length").alias("bytes"))
    n = max(1, index.sparkSession.sparkContext.defaultParallelism * 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows: list[tuple] = []
                for seq, payload in enumerate(_records(where, f"{base}/{name}")):
                    doc_id, ids = unframe(payload)
                    rows.append((seq, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) >= 10_000:
                        yield _row_batch(name, rows)
                        rows = []
                yield _row_batch(name, rows)

    return files.repartition(n, "file").mapInArrow(run, ROWS)


def _row_batch(name: str, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array([name] * len(rows), pa.string()), *[pa.array(c, pa.int64()) for c in columns]],
        names=["file", "seq", "doc_id", "n_tokens", "ids_crc32"],
    )


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """``doc_id`` and ``ids`` of the index rows given, in any order: a shuffled read.

    Every task reads only the byte ranges of its own rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            out_ids, out_docs, source, opened = [], [], None, None
            for r in batch.to_pylist():
                if r["file"] != opened:
                    opened, source = r["file"], where.open_input_file(f"{base}/{r['file']}")
                source.seek(r["offset"])
                doc_id, ids = unframe(_checked(source.read(r["length"]), 0, opened))
                out_docs.append(doc_id)
                out_ids.append(ids.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_docs, pa.int64()), pa.array(out_ids, pa.list_(pa.int64()))],
                names=["doc_id", "ids"],
            )

    return index.select("file", "offset", "length").mapInArrow(run, "doc_id bigint, ids array<bigint>")


def positions(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the number of ids in all records before.

    Runs within a file and adds up the files before it, a table of one row per file.
    """
    inside = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("in_file"))
    offsets = totals.select("file", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("base"))
    return rows.join(offsets, "file").withColumn(
        "start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    )
