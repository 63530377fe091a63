"""Corpus preparation: rejects, near duplicates, benchmark leaks, source mix, binary records.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as Parquet and read again
as the next stage's ``docs``. All but the last return the columns of ``documents``.

Rows are known by a 64-bit hash of all their columns, so null ids and one id with several texts are told
apart. Equal rows share that key and are one row with a count: the join keeps one of them, the mix
returns as many as it takes of all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatch.llm import decontaminate, mixing, quality, similarity
from millwatch.llm.catalog import table
from millwatch.llm.on_documents import encoded
from millwatch.llm.store import keep

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of ``docs``."""
    return quality.accepted(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of the row; whether a column is null counts too."""
    return docs.withColumn("key", F.xxhash64(*COLUMNS, *[F.col(c).isNull() for c in COLUMNS]))


def one_of_each(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """A row for each of ``keys``; the rows of a key are equal."""
    row = F.struct(*COLUMNS)
    found = docs.join(keys, "key", "left_semi").groupBy("key").agg(F.min(row).alias("row"))
    return found.select("key", "row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id, null last, of each group of near duplicates."""
    docs = keyed(docs)
    groups = similarity.similar_groups(docs, "key").select(F.col("doc_id").alias("key"), "component_id")
    rows = groups.groupBy("key").agg(F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    ids = docs.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    named, _ = keep(rows.join(ids, "key"), "rows")
    firsts, _ = keep(named.groupBy("component_id").agg(F.min_by("key", order).alias("key")), "firsts")
    # rows alone of their kind stay in place; of equal rows one is taken
    rest, _ = keep(
        named.filter("n > 1").select("key").union(named.filter("n = 1").select("key").join(firsts, "key", "left_anti")),
        "rest",
    )
    several, _ = keep(named.filter("n > 1").select("key").join(firsts, "key", "left_semi"), "several")
    alone = docs.join(rest, "key", "left_anti").select(*COLUMNS)
    return alone.union(one_of_each(docs, several).select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: a row for each epoch, all under its id."""
    docs = keyed(docs)
    bounds, unsettled = mixing.cuts(docs, (5.0, 2.0, 1.0), doc_id="key")
    unsettled = unsettled.withColumnRenamed("doc_id", "key")
    settled = mixing.with_epochs(docs, bounds, doc_id="key").join(unsettled.select("key"), "key", "left_anti")
    rest = one_of_each(docs, unsettled).join(unsettled, "key")
    epoch = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("epochs")))
    return (
        settled.filter("epochs > 0").select(*COLUMNS, epoch)
        .union(rest.filter("epochs > 0").select(*COLUMNS, epoch))
        .select(*COLUMNS)
    )


def binary_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, written as records and described from the files."""
    return encoded(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("binary records", binary_records),
]

#: Statistics, sketches and byte-pair codes have no SQL form; tests/llm holds brute-force checks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
