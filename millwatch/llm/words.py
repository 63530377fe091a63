"""Words and word shingles of Arrow text columns, as 64-bit hashes.

A word is a run of ``[^\\x20\\x09-\\x0D]``; A-Z count as a-z. A shingle is ``width`` words in a row.
All functions work on whole texts, a bounded slice of rows at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE_BYTES = 2_000_000
WIDTH = 5

_SEED = np.random.default_rng(20240229)
_ODD = np.uint64(1)
_POSITIONS = 4096


def _odd(n: int) -> np.ndarray:
    return _SEED.integers(0, 2**64, n, dtype=np.uint64) | _ODD


_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_EXACT = _odd(256) * _IS_WORD
_FOLDED = _EXACT.copy()
_FOLDED[0x41:0x5B] = _EXACT[0x61:0x7B]
_PLACE = _odd(_POSITIONS)
_TURN = _odd(64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Words:
    """Words of some rows: byte spans in ``data``, hashes, and each row's range of words."""

    data: np.ndarray
    rows: np.ndarray  # byte range of row i: rows[i]:rows[i + 1]
    start: np.ndarray
    stop: np.ndarray
    bounds: np.ndarray  # word range of row i: bounds[i]:bounds[i + 1]
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.rows) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and their offsets; nulls are empty."""
    column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def split(
    column: pa.Array,
    fold: bool = True,
    inside: np.ndarray = _IS_WORD,
    cut: Callable[[np.ndarray], np.ndarray] | None = None,
) -> Words:
    """Words of every row.

    ``fold`` hashes A-Z as a-z, ``inside`` says which bytes make words, and ``cut`` marks the bytes
    at which a new word begins inside one.
    """
    data, rows = text_bytes(column)
    of_words = inside
    inside = of_words[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True  # a word never crosses rows
    if cut is not None:
        edge[:-1] |= cut(data)
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    stop = np.flatnonzero(inside & (~after | edge[1:])) + 1
    bounds = np.searchsorted(start, rows)
    if not len(start):
        return Words(data, rows, start, stop, bounds, np.zeros(0, np.uint64))
    value = ((_FOLDED if fold else _EXACT) * of_words)[data]
    place = np.arange(len(data), dtype=np.int64)
    place[start[0] :] -= np.repeat(start, np.diff(np.append(start, len(data))))
    value *= _PLACE[place % _POSITIONS]
    hashes = mix(np.add.reduceat(value, start))
    return Words(data, rows, start, stop, bounds, hashes)


def shingles(words: Words, width: int = WIDTH, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes in text order, and each row's range of them.

    With ``short``, a row with 1 to ``width - 1`` words has one shingle, its whole sequence.
    """
    counts = words.counts
    n = np.maximum(counts - (width - 1), 0)
    h = words.hashes
    total = max(len(h) - (width - 1), 0)
    value = np.zeros(total, np.uint64)
    for k in range(width):
        value += h[k : k + total] * _TURN[k]
    ends = np.repeat(words.bounds[1:], counts)[:total]
    value = mix(value[np.arange(total) + (width - 1) < ends])
    if short and (few := np.flatnonzero((counts > 0) & (counts < width))).size:
        whole = np.zeros(len(few), np.uint64)
        for k in range(width - 1):
            has = counts[few] > k
            whole[has] += h[words.bounds[few[has]] + k] * _TURN[k]
        whole = mix(whole + counts[few].astype(np.uint64) * _TURN[-1])
        at = np.concatenate([[0], np.cumsum(n)])[few]
        value = np.insert(value, at, whole)
        n = n.copy()
        n[few] = 1
    return value, np.concatenate([[0], np.cumsum(n)])


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of ``batch`` with about ``limit`` bytes of text each, one row at least."""
    column = batch.column(text)
    if not batch.num_rows:
        return
    sizes = np.array(pa.compute.binary_length(column).fill_null(0), np.int64)
    part = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(low, high - low)


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def folded_words(text: str | None) -> list[str]:
    """Words of one text as strings, for exact checks of few rows."""
    return _WORD.findall((text or "").translate(_LOWER))
