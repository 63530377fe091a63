"""Queries over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    decontaminate, fingerprint, language, mixing, packing, quality, records, similarity, spelling,
)
from .catalog import query, table
from .store import keep

TOKENIZER = "word_bpe_49k.json"

_WORDS_SQL = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"""
_RUNS_SQL = "list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))"

CONTAINED_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS ws FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest({_RUNS_SQL}) AS sh FROM d WHERE len(ws) >= 5),
bs AS (SELECT DISTINCT item_id, unnest({_RUNS_SQL}) AS sh FROM b WHERE len(ws) >= 5),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
found AS (
  SELECT doc_id, item_id, n_shingles, count(*) AS n_shared
  FROM ds JOIN bs USING (sh) JOIN n USING (item_id) GROUP BY ALL
  HAVING 10 * count(*) >= 8 * n_shingles
  UNION ALL
  SELECT doc_id, item_id, 1, 1 FROM d, b
  WHERE len(b.ws) BETWEEN 1 AND 4
    AND contains(' ' || array_to_string(d.ws, ' ') || ' ', ' ' || array_to_string(b.ws, ' ') || ' '))
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment FROM found"""

GROUPS_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS_SQL} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                                      ELSE {_RUNS_SQL} END) AS sh FROM d),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
  FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b, i = p.n AND i = q.n AS equal
  FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 80 * (p.n + q.n - i)),
steps AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS far FROM d
  UNION SELECT node, steps.b FROM reach JOIN steps ON steps.a = far),
low AS (SELECT node AS doc_id, min(far) AS component_id FROM reach GROUP BY node),
classes AS (SELECT b AS doc_id, min(a) AS class_id FROM links WHERE equal GROUP BY b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(class_id, d.doc_id) AS class_id
FROM d LEFT JOIN n USING (doc_id) JOIN low USING (doc_id) LEFT JOIN classes USING (doc_id)"""


@query(CONTAINED_SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    docs = table(spark, sf_dir, "documents")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))


@query()
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"), (5.0, 2.0, 1.0)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query(GROUPS_SQL)
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents."""
    return similarity.similar_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "class_id"
    )


@query()
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encoded(docs: DataFrame) -> DataFrame:
    """Writes the records, reads them back and places every document."""
    folder = scratch_path(docs.sparkSession, "records")
    index, _ = keep(records.write(docs, folder, tokenizer_path(), end=2), "index")
    return records.positions(records.read(index, folder)).select(
        "doc_id", F.col("start").cast("bigint").alias("start"), "n_tokens", "ids_crc32"
    )


@query()
def op9_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, as read back from the files."""
    return encoded(table(spark, sf_dir, "documents"))


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


@query()
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


_VARIANTS_SQL = """
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
sums AS (
  SELECT run, n, length(run) AS size, 4294967295 - list_reduce(
           list_prepend(4294967295, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
             lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                            ELSE [CAST(195 AS BIGINT), CAST(unicode(c) - 64 AS BIGINT)] END))),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS h
  FROM counted),
words AS MATERIALIZED (
  SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, h % size) || substring(run, h % size + 2) ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM sums GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
holes AS MATERIALIZED (
  SELECT DISTINCT word, n, length(word) AS size, k, substring(word, 1, k) || substring(word, k + 2) AS rest
  FROM words, unnest(range(0, length(word))) t(k)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b USING (size, k, rest) WHERE a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.rest
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.rest),
near AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS best, max(m) AS best_n FROM pairs GROUP BY word),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
         CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)),
follow AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT f.word, f.next, forms.form FROM follow f JOIN forms ON forms.word = f.next)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN follow USING (word) WHERE next IS NULL"""


@query(_VARIANTS_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words with the words one edit away, and the form each is a variant of."""
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


@query()
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 4,096 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())
