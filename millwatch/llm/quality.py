"""Quality classifier: a regularised quadratic discriminant over document statistics.

Every whole text is reduced to a dozen transformed statistics (shape of words, characters,
repetition, layout). Per class, the mean and a covariance shrunk towards the pooled covariance and
a multiple of the identity are estimated from labelled rows; scores are the logistic of the
difference of the two Gaussian log-densities, whose Mahalanobis terms use Cholesky factors computed once.

Training sums moments in Spark, over all labelled rows: only 2 x (1 + d + d x d) numbers reach the
driver, however many rows there are.

Edge cases: null and empty texts have the statistics of an empty text and get a score like any
other. Repeated rows count as often as they occur. Labels that are null or disagree on a document are not
used; rows with a null id are scored and never learnt from. Without labels of both classes every
score is 0.5. Empty tables give no rows. Other columns are never inputs, and the filter keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import keep

STATISTICS = (
    "words", "word_length", "length_spread", "upper", "digits", "marks", "symbols", "beyond_ascii",
    "distinct", "repeats", "commonest", "lines", "short_words",
)
D = len(STATISTICS)
SHRINK_POOLED = 0.1
SHRINK_IDENTITY = 0.02

_KIND = np.zeros(256, np.int64)  # 0: other letters and bytes beyond ASCII
_KIND[0x41:0x5B] = 1
_KIND[0x61:0x7B] = 2
_KIND[0x30:0x3A] = 3
_KIND[[ord(c) for c in ".,;:'\"!?()-"]] = 4
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 6
_KIND[0x0A] = 7
_KINDS = 8


def statistics(column: pa.Array) -> np.ndarray:
    """The transformed statistics of every text, one row each."""
    split = W.split(column)
    n = len(split.rows) - 1
    size = np.diff(split.rows)
    row = np.repeat(np.arange(n), size)
    kind = np.bincount(row * _KINDS + _KIND[split.data], minlength=n * _KINDS).reshape(n, _KINDS)
    count = split.counts
    some = np.maximum(count, 1)
    length = (split.stop - split.start).astype(float)
    owner = split.owner()
    mean = np.bincount(owner, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(owner, length**2, n) / some - mean**2, 0))
    short = np.bincount(owner, length <= 3, n) / some
    same = np.zeros(len(owner), bool)
    same[1:] = (split.hashes[1:] == split.hashes[:-1]) & (owner[1:] == owner[:-1])
    distinct, most = np.zeros(n), np.zeros(n)
    for i in np.flatnonzero(count):
        times = np.unique(split.hashes[split.bounds[i] : split.bounds[i + 1]], return_counts=True)[1]
        distinct[i], most[i] = len(times), times.max()
    chars = np.maximum(size - kind[:, 6] - kind[:, 7], 1)
    letters = np.maximum(kind[:, 0] + kind[:, 1] + kind[:, 2], 1)
    return np.stack(
        [
            np.log1p(count),
            np.log1p(mean),
            np.log1p(spread),
            np.sqrt(kind[:, 1] / letters),
            np.sqrt(kind[:, 3] / chars),
            np.sqrt(kind[:, 4] / some),
            np.sqrt(kind[:, 5] / some),
            np.sqrt(kind[:, 0] / chars),
            # prose keeps to a power law: the exponent, not the share, is comparable over lengths
            np.log1p(distinct) / np.log1p(some),
            np.sqrt(np.bincount(owner, same, n) / some),
            np.sqrt(most / some),
            np.sqrt(kind[:, 7] / some),
            short,
        ],
        axis=1,
    )


def held_out(doc_id: Column) -> Column:
    """Whether the document is kept from training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, x``: the statistics of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, "text"):
                x = statistics(part.column("text"))
                flat = pa.array(x.ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * D, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "x"])

    named = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return named.mapInArrow(run, "doc_id bigint, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log weights of the two classes."""

    centre: np.ndarray
    scale: np.ndarray
    mean: tuple[np.ndarray, np.ndarray]
    root: tuple[np.ndarray, np.ndarray]
    offset: tuple[float, float]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        density = [
            self.offset[c] - 0.5 * np.sum(((z - self.mean[c]) @ self.root[c].T) ** 2, axis=1)
            for c in (0, 1)
        ]
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(labelled: DataFrame) -> Discriminant | None:
    """The discriminant of ``x, y`` rows with y 0 or 1; None if a class has no row."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + D + D * D))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_pydict(
            {
                "at": pa.array(np.arange(total.size)),
                "value": pa.array(total.ravel()),
            }
        )

    rows = (
        labelled.select("x", F.col("y").cast("int").alias("y"))
        .mapInArrow(moments, "at bigint, value double")
        .groupBy("at").agg(F.sum("value").alias("value")).collect()
    )
    total = np.zeros((2, 1 + D + D * D))
    for r in rows:
        total.flat[r["at"]] = r["value"]
    n = total[:, 0]
    if not n.all():
        return None
    mean = total[:, 1 : 1 + D] / n[:, None]
    cov = [(total[c, 1 + D :] / n[c]).reshape(D, D) - np.outer(mean[c], mean[c]) for c in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    centre = (n @ mean) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    pooled = pooled / np.outer(scale, scale)
    means, roots, offsets = [], [], []
    for c in (0, 1):
        own = cov[c] / np.outer(scale, scale)
        own = (1 - SHRINK_POOLED) * own + SHRINK_POOLED * pooled
        own = (1 - SHRINK_IDENTITY) * own + SHRINK_IDENTITY * np.trace(own) / D * np.eye(D)
        factor = np.linalg.cholesky(own)
        means.append((mean[c] - centre) / scale)
        roots.append(np.linalg.inv(factor))
        offsets.append(float(np.log(n[c] / n.sum()) - np.log(np.diag(factor)).sum()))
    return Discriminant(centre, scale, tuple(means), tuple(roots), tuple(offsets))


def train(stats: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> Discriminant | None:
    """Learns from labelled documents that are not held out."""
    marks = (
        labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .filter("y in (0, 1) and doc_id is not null")
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("top")).filter("y = top")
    )
    return fit(stats.filter(~held_out(F.col("doc_id"))).join(marks.select("doc_id", "y"), "doc_id"))


def _scores(model: Discriminant | None, x: np.ndarray) -> np.ndarray:
    return model.score(x) if model else np.full(len(x), 0.5)


def score(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    stats, _ = keep(document_statistics(docs, doc_id, text), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(train(stats, labels, "doc_id", label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_scores(model.value, x))], names=["doc_id", "score"]
            )

    return stats.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    least: float = 0.5,
) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``least``; texts are never shuffled."""
    stats, _ = keep(document_statistics(docs, doc_id, text), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(train(stats, labels, "doc_id", label))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text):
                good = _scores(model.value, statistics(part.column(text))) >= least
                yield part.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
