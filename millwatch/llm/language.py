"""Language of code-switched text: a linear-chain conditional random field over words.

Every run of letters is a word with a hidden language. A word's features are hashed: its affixes (byte
n-grams with the word's edge), inner n-grams, and itself as a lexicon entry. Transition weights say how
languages follow each other. Emission and transition weights are learned together by gradient steps on
the conditional likelihood, whose expectations come from forward-backward; the words of a training
document all carry the document's language. A text's language is the one with the largest sum of word
posteriors, and the score is its share.

Forward-backward is exact for any length: words are cut into segments of equal length, each segment's
transfer matrix is computed for all segments at once, a scan over the few segments of a text links them,
and a second pass fills in the posteriors. Texts are processed whole, a bounded slice of rows at a time.

Training reads at most ``per_language`` documents of every language, chosen by a hash of id and text,
and ``window`` words of each, which is what bounds the driver's memory. Texts are scored where they lie.

Edge cases: null texts and texts without a letter are ``und`` with score 0. Ties go to the language
that is first in code point order. Rows with a null id are scored and never learnt from; repeated rows count
as often as they occur. With no labelled text everything is ``und`` with score 0. Empty tables give
no rows. The language column is used in training only; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scale import bounded_rows
from . import words as W
from .quality import held_out

PER_LANGUAGE = 400
WINDOW = 250
MOST_LANGUAGES = 1_000
TABLE_BITS = 17
SEGMENT = 64
ROUNDS = 25
STEP = 0.3
DECAY = 1e-4
SHORTEST, LONGEST = 1, 4

_LETTERS = np.zeros(256, bool)
_LETTERS[0x41:0x5B] = True
_LETTERS[0x61:0x7B] = True
_LETTERS[0x80:] = True


@dataclass(frozen=True)
class Features:
    """Feature numbers of the distinct words, and the word of every place."""

    which: np.ndarray  # place -> distinct word
    feature: np.ndarray
    word: np.ndarray  # distinct word of each feature
    n_words: int


def word_features(split: W.Words) -> Features:
    """Hashed features of the words, each distinct one looked at once."""
    _, first, which = np.unique(split.hashes, return_index=True, return_inverse=True)
    raw = split.data.tobytes()
    spans = zip(split.start[first].tolist(), split.stop[first].tolist(), strict=True)
    # one string for all: lower-casing and encoding are then single calls
    joined = "\n".join(raw[a:b].decode("utf-8", "replace") for a, b in spans).lower()
    text = np.frombuffer(("\n" + joined + "\n").encode("utf-8"), np.uint8)
    edge = np.flatnonzero(text == 10)
    n = len(first)
    if not n:
        return Features(which, np.zeros(0, np.int64), np.zeros(0, np.int64), 0)
    word = np.cumsum(text == 10) - 1  # the edge before a word belongs to it
    hashes, owners = [], []
    value = np.zeros(len(text), np.uint64)
    for size in range(1, LONGEST + 1):
        value = value[: len(text) - size + 1] * np.uint64(1099511628211) + text[size - 1 :] + np.uint64(size)
        if size < SHORTEST + 1:
            continue
        at = np.arange(len(value))
        # inside one word, where both of its edges may take part
        inside = at + size - 1 <= edge[np.minimum(word[: len(value)] + 1, len(edge) - 1)]
        hashes.append(W.mix(value[inside]))
        owners.append(word[: len(value)][inside])
    prefix = np.zeros(len(text) + 1, np.uint64)
    power = np.uint64(0x9E3779B97F4A7C15)
    np.cumsum(W.mix(text.astype(np.uint64) + power * (np.arange(len(text)) - edge[word]).astype(np.uint64)), out=prefix[1:])
    hashes.append(W.mix(prefix[edge[1:]] - prefix[edge[:-1]]))
    owners.append(np.arange(n))
    keep_word = np.concatenate(owners)
    feature = (np.concatenate(hashes) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
    order = np.argsort(keep_word, kind="stable")
    return Features(which, feature[order], keep_word[order], n)


def emissions(features: Features, table: np.ndarray) -> np.ndarray:
    """Scores of every place for every language."""
    if not features.n_words:
        return np.zeros((0, table.shape[1]))
    starts = np.searchsorted(features.word, np.arange(features.n_words))
    return np.add.reduceat(table[features.feature], starts, axis=0)[features.which]


def forward_backward(score: np.ndarray, bounds: np.ndarray, transition: np.ndarray, pairs: bool = False):
    """Posteriors of every word; with ``pairs`` also the expected number of each transition.

    Row ``i`` holds the words ``bounds[i]:bounds[i + 1]``. The label before a row's first word is uniform.
    """
    n_labels = score.shape[1]
    counts = np.diff(bounds)
    step = np.exp(transition - transition.max())
    if not len(score):
        return np.zeros((0, n_labels)), np.zeros((n_labels, n_labels))
    per_row = -(-counts // SEGMENT)
    first = np.concatenate([[0], np.cumsum(per_row)])
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(score)) - bounds[row]
    segment, at = first[row] + place // SEGMENT, place % SEGMENT
    total = int(first[-1])
    emit = np.ones((SEGMENT, total, n_labels))
    emit[at, segment] = np.exp(score - score.max(axis=1, keepdims=True))
    real = np.zeros((SEGMENT, total, 1), bool)
    real[at, segment] = True
    carry = np.broadcast_to(np.eye(n_labels), (total, n_labels, n_labels)).copy()
    for t in range(SEGMENT):
        moved = (carry.reshape(-1, n_labels) @ step).reshape(carry.shape) * emit[t][:, None, :]
        carry = np.where(real[t][:, :, None], moved / moved.max(axis=(1, 2), keepdims=True), carry)
    enter = np.full((total, n_labels), 1.0 / n_labels)
    leave = np.ones((total, n_labels))
    for k in range(1, int(per_row.max())):
        now = first[:-1][per_row > k] + k
        to = np.einsum("ri,rij->rj", enter[now - 1], carry[now - 1])
        enter[now] = to / to.sum(axis=1, keepdims=True)
        last = first[1:][per_row > k] - 1 - k
        to = np.einsum("rij,rj->ri", carry[last + 1], leave[last + 1])
        leave[last] = to / to.max(axis=1, keepdims=True)
    forward = np.empty((SEGMENT, total, n_labels))
    state = enter
    for t in range(SEGMENT):
        moved = (state @ step) * emit[t]
        state = np.where(real[t], moved / moved.sum(axis=1, keepdims=True), state)
        forward[t] = state
    expected = np.zeros((n_labels, n_labels))
    state = leave
    posterior = np.empty((len(score), n_labels))
    backward = np.empty_like(forward)
    for t in range(SEGMENT - 1, -1, -1):
        backward[t] = state
        ahead = emit[t] * state
        if pairs:
            before = forward[t - 1] if t else enter
            joint = before[:, :, None] * step[None] * ahead[:, None, :]
            joint = joint / joint.sum(axis=(1, 2), keepdims=True)
            expected += (joint * real[t][:, :, None]).sum(axis=0)
        moved = ahead @ step.T
        state = np.where(real[t], moved / moved.max(axis=1, keepdims=True), state)
    posterior = (forward * backward)[at, segment]
    return posterior / posterior.sum(axis=1, keepdims=True), expected


@dataclass(frozen=True)
class Field:
    """The languages in code point order with their weights."""

    languages: tuple[str, ...]
    table: np.ndarray
    transition: np.ndarray


def fit(texts: list[str], langs: list[str], rounds: int = ROUNDS) -> Field | None:
    """Learns from short texts, each in one language."""
    languages = tuple(sorted(set(langs)))
    if not languages:
        return None
    number = {name: i for i, name in enumerate(languages)}
    split = W.split(pa.array(texts, pa.string()), inside=_LETTERS)
    features = word_features(split)
    n = len(languages)
    gold = np.zeros((len(split.hashes), n))
    gold[np.arange(len(gold)), np.array([number[x] for x in langs], np.int64)[split.owner()]] = 1.0
    # every language counts the same, however many words of it the sample has
    share = np.maximum(gold.sum(axis=0), 1.0)
    weight = (gold @ (1.0 / share))[:, None] * len(gold) / n
    table = np.zeros((1 << TABLE_BITS, n))
    pull = np.zeros_like(table)
    transition = np.zeros((n, n))
    moves = np.zeros((n, n))
    counts = split.counts
    for i, c in zip((number[x] for x in langs), counts.tolist(), strict=True):
        moves[i, i] += max(0, c - 1)
        moves[:, i] += 1.0 / n if c else 0.0
    push = np.zeros((n, n))
    for _ in range(rounds):
        posterior, expected = forward_backward(emissions(features, table), split.bounds, transition, True)
        wrong = (gold - posterior) * weight
        by_word = np.stack([np.bincount(features.which, wrong[:, c], features.n_words) for c in range(n)], axis=1)
        slope = np.stack(
            [np.bincount(features.feature, by_word[features.word, c], len(table)) for c in range(n)], axis=1
        ) - DECAY * table * len(gold)
        pull += slope**2
        table += STEP * slope / (np.sqrt(pull) + 1e-8)
        slope = (moves - expected) - 0.1 * transition * len(gold) / 1000
        push += slope**2
        transition += STEP * slope / (np.sqrt(push) + 1e-8)
    return Field(languages, table.astype(np.float32), transition)


def label(field: Field | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of every text."""
    n = len(column)
    names = ["und"] * n
    share = np.zeros(n)
    if field is None:
        return names, share
    split = W.split(column, inside=_LETTERS)
    posterior, _ = forward_backward(
        emissions(word_features(split), field.table).astype(float), split.bounds, field.transition
    )
    sums = np.stack(
        [np.bincount(split.owner(), posterior[:, c], n) for c in range(len(field.languages))], axis=1
    )
    some = split.counts > 0
    ascii_letter = np.bincount(
        np.repeat(np.arange(n), np.diff(split.rows)), _LETTERS[split.data] & (split.data < 0x80), n
    )
    for i in np.flatnonzero(some & (ascii_letter == 0)):
        some[i] = any(c.isalpha() for c in column[int(i)].as_py())
    best = np.argmax(sums, axis=1)
    for i in np.flatnonzero(some):
        names[i] = field.languages[best[i]]
        share[i] = min(1.0, sums[i, best[i]] / split.counts[i])
    return names, share


def training_sample(
    docs: DataFrame, per_language: int, window: int
) -> tuple[list[str], list[str]]:
    """Texts and languages of at most about ``per_language`` documents of each language."""
    open_rows = docs.filter(~held_out(F.col("doc_id"))).filter(
        "doc_id is not null and lang is not null and text is not null"
    )
    sizes = open_rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    drawn = F.pmod(F.xxhash64(F.lit(5), "doc_id", F.length("text")), F.lit(1 << 40)) / float(1 << 40)
    # the model has weights for each language, so their number is small, or this fails
    shares = [(r["lang"], per_language / r["n"]) for r in bounded_rows(sizes, MOST_LANGUAGES, "languages")]
    if not shares:
        return [], []
    share = F.create_map(*[F.lit(x) for pair in shares for x in pair])
    chosen = open_rows.filter(drawn < F.element_at(share, F.col("lang")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, seed in zip(batch.column("text").to_pylist(), batch.column("seed").to_pylist(), strict=True):
                words = text.split()
                at = seed % max(1, len(words) - window + 1)
                texts.append(" ".join(words[at : at + window]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("lang")], names=["text", "lang"])

    rows = (
        chosen.select("text", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("seed"))
        .mapInArrow(cut, "text string, lang string")
        .collect()
    )
    rows.sort()
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def identify(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = PER_LANGUAGE,
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``."""
    named = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.col(lang).cast("string").alias("lang"),
    )
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_sample(named, per_language, window)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                names, share = label(model.value, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(share)],
                    names=["doc_id", "lang_pred", "score"],
                )

    found = named.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
