"""Mixing sources to target weights: whole epochs, then a weighted sample without replacement.

Every source gets its weight's share of the budget; a share stops at ``max_epochs`` times the
source's size and the excess goes to the other sources by weight, again and again until no share
is above its limit. A source whose target is ``e + f`` times its size repeats every document ``e``
times and samples the rest by Efraimidis and Spirakis: a document's key is an exponential
variate divided by its quality weight, and the documents with the smallest keys are taken until
their sizes reach the rest of the target.

A source is never sorted in one task. Its keys are counted in bins that widen with the key, bins with
many rows are cut evenly, and the order of these cells is the order of keys; cell totals are
prefix-summed, and only running sums inside a cell need its rows together. A cell holds about
``cell_rows`` rows at any size of the source and under any weights; rows equal in id and text share one.

What is sampled is a prefix of the keys, but for one closing document. So ``cuts`` describes a mix by one
bound per source and at most two documents of each, and ``with_epochs`` applies it to the documents
where they lie: their texts are never shuffled.

Edge cases: a null or empty text has size 0 and is taken 0 times. A null source is a source of its
own, last in order. Equal keys are ordered by id, then text; rows that are equal in all of these
may be taken in either order, with the same words. A null id hashes like any other value. Sources
without words have target 0. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import keep

SPACES = " \t\n\x0b\f\r"
CELL_ROWS = 4_000
BINS = 16
"""Bins of keys for each doubling of the key."""
_LOWEST = -64 * BINS


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null has none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    runs = F.size(F.split(body, "[\\x20\\x09-\\x0D]+", -1))
    return F.when(body == "", F.lit(0)).otherwise(runs).cast("bigint")


def quality_weight(n_chars: Column, size: Column) -> Column:
    """Between 0.25 and 1: highest when words are about as long as in prose (6 with the gap)."""
    per_word = n_chars / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(0.25), F.lit(1.0) / (1.0 + F.abs(F.log(F.greatest(per_word, F.lit(0.1)) / 6.0))))


def source_targets(
    sources: DataFrame, weights: Sequence[float], budget_share: float, max_epochs: float
) -> DataFrame:
    """Targets of ``(source, source_size)`` rows; weights repeat over the sources by code point.

    One row per source; each round of sharing is an aggregation over them that returns two sums.
    """
    spark = sources.sparkSession
    # one row per source: small beside the documents, and ranked only here
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sources.select(
        "source", "source_size", F.element_at(cycle, (place % len(weights) + 1).cast("int")).alias("weight")
    )
    ranked, _ = keep(ranked, "sources")
    cap = F.col("source_size") * float(max_epochs)
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * budget_share
    level = 0.0
    while True:
        capped = cap <= F.col("weight") * level
        row = ranked.agg(
            F.sum(F.when(capped, cap).otherwise(0.0)).alias("full"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        higher = (total - row["full"]) / row["open"]
        if higher <= level:
            break
        level = higher
    return ranked.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def order_key(doc_id: Column, text_hash: Column, n_chars: Column, size: Column, seed: int) -> Column:
    """Exponential variate over the quality weight; uniform draws come from the id and the text, with 53 bits."""
    drawn = F.pmod(F.xxhash64(F.lit(seed), doc_id, text_hash), F.lit(1 << 53)).cast("double")
    uniform = (drawn + 0.5) / float(1 << 53)
    return -F.log(uniform) / quality_weight(n_chars, size)


def _measures(doc_id: str, text: str) -> dict[str, Column]:
    body = F.coalesce(F.col(text), F.lit(""))
    return {
        "doc_id": F.col(doc_id).cast("bigint"),
        "size": n_words(F.col(text)),
        "text_hash": F.xxhash64(body),
        "n_chars": F.length(body),
    }


def with_cells(rows: DataFrame, cell_rows: int) -> DataFrame:
    """Adds ``cell``, which rises with ``key`` within a source and holds about ``cell_rows`` rows."""
    growth = 2.0 ** (1.0 / BINS)
    of_key = F.coalesce(F.floor(F.log2("key") * BINS), F.lit(_LOWEST))  # no logarithm: the key is 0
    rows = rows.withColumn("bin", of_key.cast("bigint"))
    counts = rows.groupBy(F.col("source").alias("s"), F.col("bin").alias("b")).agg(
        F.ceil(F.count(F.lit(1)) / cell_rows).alias("parts")
    )
    along = (F.col("key") / F.pow(F.lit(2.0), F.col("bin") / BINS) - 1.0) / (growth - 1.0)
    part = F.greatest(F.lit(0), F.least(F.floor(along * F.col("parts")), F.col("parts") - 1))
    return (
        rows.join(counts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bin") == F.col("b")))
        .withColumn("cell", (F.col("bin") - _LOWEST) * (1 << 40) + part)
        .drop("s", "b", "bin", "parts")
    )


def _sampled(
    docs: DataFrame,
    weights: Sequence[float],
    budget_share: float,
    max_epochs: int,
    doc_id: str,
    text: str,
    source: str,
    seed: int,
    cell_rows: int,
    also: Sequence[str] = (),
) -> DataFrame:
    """Documents with the epochs of their source and whether the sample takes them once ``more``."""
    named = docs.select(
        F.col(source).cast("string").alias("source"),
        *[c.alias(name) for name, c in _measures(doc_id, text).items()],
    )
    measured, _ = keep(named, "sizes")
    totals = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, budget_share, max_epochs)
    per_doc = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets.withColumn("whole", F.floor(per_doc + 1e-12)).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))
    )
    key = order_key(F.col("doc_id"), F.col("text_hash"), F.col("n_chars"), F.col("size"), seed)
    rows = with_cells(
        measured.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("key", key),
        cell_rows,
    )
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("in_cell"))
    offsets = cells.select(
        F.col("source").alias("s"), F.col("cell").alias("c"),
        F.coalesce(F.sum("in_cell").over(before), F.lit(0)).alias("offset"),
    )
    inside = (
        Window.partitionBy("source", "cell")
        .orderBy("key", "doc_id", "text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    # the last document is taken when at least half of it is within the budget
    more = (reached + F.col("size") / 2 <= F.col("rest")) & (F.col("size") > 0)
    numbered = F.row_number().over(Window.partitionBy("source", "cell").orderBy("key", "doc_id", "text_hash"))
    return keep(
        rows.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
        .withColumn("more", more.cast("int"))
        .withColumn("at", F.struct("cell", numbered.alias("n")))
        .select(
            "doc_id", "source", "size", "source_size", "target", "whole", "rest", "more", "at", *also
        ),
        "sample",
    )[0]


def _decided(sampled: DataFrame, max_epochs: int) -> DataFrame:
    """Adds ``swap``, whether the document is its source's closing one, and the final ``epochs``."""
    more = F.when(F.col("swap"), 1 - F.col("more")).otherwise(F.col("more"))
    return (
        sampled.join(_closing(sampled), F.col("source").eqNullSafe(F.col("s")), "left")
        .withColumn("swap", F.coalesce(F.col("at") == F.col("closing"), F.lit(False)))
        .withColumn("epochs", F.least(F.col("whole") + more, F.lit(max_epochs)).cast("bigint"))
        .drop("s", "closing")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    budget_share: float = 1.0,
    max_epochs: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 17,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, epochs, taken``.

    ``taken`` is ``epochs * size`` words; reruns on the same rows agree.
    """
    sampled = _sampled(docs, weights, budget_share, max_epochs, doc_id, text, source, seed, cell_rows)
    return _decided(sampled, max_epochs).select(
        "doc_id", "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size")).alias("taken"),
    )


def cuts(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    budget_share: float = 1.0,
    max_epochs: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 17,
    cell_rows: int = CELL_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The same mix as one bound per source, and the documents that the bounds do not settle.

    The first frame is for ``with_epochs``. The second has ``doc_id, epochs, n`` of the last document
    taken and of the closing one of each source: ``epochs`` of all its ``n`` rows together, as rows equal in
    id and text may be taken in part. Ids must tell different texts and sources apart.
    """
    sampled = _sampled(
        docs, weights, budget_share, max_epochs, doc_id, text, source, seed, cell_rows, ("key", "text_hash")
    )
    order = F.struct("key", "doc_id", "text_hash")
    decided = _decided(sampled, max_epochs)
    bounds, _ = keep(
        decided.groupBy("source").agg(
            F.max("whole").alias("whole"),
            F.max(F.when(F.col("more") == 1, order)).alias("cut"),
            F.max(F.when(F.col("swap"), order)).alias("closing"),
        ),
        "bounds",
    )
    ends = bounds.select(F.col("source").alias("s"), "cut", "closing")
    unsettled = F.coalesce(order == F.col("cut"), F.lit(False)) | F.coalesce(order == F.col("closing"), F.lit(False))
    special, _ = keep(
        decided.join(ends, F.col("source").eqNullSafe(F.col("s")))
        .filter(unsettled)
        .groupBy("doc_id")
        .agg(F.sum("epochs").alias("epochs"), F.count(F.lit(1)).alias("n")),
        "unsettled",
    )
    return bounds, special


def with_epochs(
    docs: DataFrame,
    bounds: DataFrame,
    max_epochs: int = 3,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 17,
) -> DataFrame:
    """``docs`` with ``epochs``, right for all documents but those that ``cuts`` returns beside ``bounds``."""
    m = _measures(doc_id, text)
    key = order_key(m["doc_id"], m["text_hash"], m["n_chars"], m["size"], seed)
    order = F.struct(key.alias("key"), m["doc_id"].alias("doc_id"), m["text_hash"].alias("text_hash"))
    more = (m["size"] > 0) & F.coalesce(order <= F.col("_bound.cut"), F.lit(False))
    epochs = F.least(F.col("_bound.whole") + more.cast("int"), F.lit(max_epochs)).cast("bigint")
    bound = bounds.select(F.struct("source", "whole", "cut").alias("_bound"))
    return (
        docs.join(bound, F.col(source).cast("string").eqNullSafe(F.col("_bound.source")))
        .withColumn("epochs", epochs)
        .drop("_bound")
    )


def _closing(sampled: DataFrame) -> DataFrame:
    """For each source the one document whose taking or leaving brings the sum nearest to its target.

    The prefix ends within half a document of the budget, which a very long document makes a lot.
    """
    gap = sampled.groupBy("source").agg(
        (F.max("rest") - F.sum(F.col("size") * F.col("more"))).alias("gap")
    )
    gap = gap.select(F.col("source").alias("s"), "gap")
    fits = (F.col("size") > 0) & (F.col("more") == F.when(F.col("gap") > 0, 0).otherwise(1))
    left = F.abs(F.abs("gap") - F.col("size"))
    return (
        sampled.join(gap, F.col("source").eqNullSafe(F.col("s")))
        .filter(fits & (left < F.abs("gap")))
        .groupBy("s").agg(F.min_by("at", F.struct(left, F.col("at"))).alias("closing"))
    )
