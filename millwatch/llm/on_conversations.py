"""Queries over the conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, trie
from .catalog import query, table
from .store import keep

# A user's turn is a call of the tool "answer", the turn after it the call's result. Turns of other roles are
# neither: they are rows without a call, named after their role.
TOOLS = (("answer", "prompt", "STRING", True), ("answer", "turn", "BIGINT", True))

_SQL = """
WITH asked AS (
  SELECT conv_id, 'call-' || turn AS call_id, turn, min(text) AS prompt, count(*) - 1 AS n_more
  FROM conversations WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
given AS (
  SELECT conv_id, 'call-' || (turn - 1) AS call_id, turn AS result_turn, min(text) AS content,
         count(*) - 1 AS n_more_results, true AS given
  FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
islands AS (
  SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island FROM asked),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) AS depth FROM islands),
both_sides AS (SELECT * FROM placed FULL JOIN given USING (conv_id, call_id)),
judged AS (
  SELECT *, CASE WHEN depth IS NULL THEN 'no_call' WHEN given IS NULL THEN 'no_result' ELSE 'linked' END AS status,
         depth IS NOT NULL AND prompt IS NULL AS bad
  FROM both_sides)
SELECT conv_id, call_id, coalesce(turn, result_turn) AS turn, result_turn, depth, status,
       CAST(bad AS INTEGER) AS n_errors, coalesce(n_more, 0) + coalesce(n_more_results, 0) AS n_repeated,
       '{"arguments":' || CASE WHEN depth IS NULL THEN 'null' ELSE '{'
         || coalesce('"prompt":' || CAST(to_json(prompt) AS VARCHAR) || ',', '') || '"turn":' || turn || '}' END
       || ',"call_id":"' || call_id || '","content":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null')
       || ',"errors":' || CASE WHEN bad THEN '["missing prompt"]' ELSE '[]' END
       || ',"name":' || CASE WHEN depth IS NULL THEN 'null' ELSE '"answer"' END
       || ',"status":"' || status || '"}' AS json
FROM judged
UNION ALL
SELECT conv_id, NULL, turn, turn, NULL, 'no_call', 0, 0,
       '{"arguments":null,"call_id":null,"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null')
       || ',"errors":[],"name":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || ',"status":"no_call"}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')"""


@query(_SQL)
def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as calls, assistant turns as their results, all other turns as rows of their own."""
    turns = table(spark, sf_dir, "conversations")
    number = lambda back: F.concat(F.lit("call-"), (F.col("turn") - back).cast("string"))
    calls = turns.filter("role = 'user'").select(
        "conv_id", number(0).alias("call_id"), "turn", F.lit("answer").alias("name"),
        F.to_json(F.struct(F.col("text").alias("prompt"), "turn")).alias("arguments"),
        number(2).alias("after"),
    )
    results = turns.filter("role = 'assistant'").select(
        "conv_id", number(1).alias("call_id"), "turn", F.col("text").alias("content"), F.lit(None).cast("string").alias("name")
    )
    neither = F.col("role").isNull() | ~F.col("role").isin("user", "assistant")
    others = turns.filter(neither).select(
        "conv_id", F.lit(None).cast("string").alias("call_id"), "turn", F.col("text").alias("content"), F.col("role").alias("name")
    )
    tools = spark.createDataFrame(TOOLS, "tool string, name string, type string, required boolean")
    return chat.link(calls, results.union(others), tools)


FAMILY = 20
"""A conversation takes its first turns from the one whose id is the next lower multiple."""
HEADS = 4

_TRIE_SQL = """
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, n, conv_id - conv_id % 20 AS base, 4294967295 - list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id)),
sized AS (
  SELECT c.conv_id, c.base, c.crc % 4 AS h, least(c.crc % 4, coalesce(b.n, 0)) AS given
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
turns AS (
  SELECT s.conv_id, o.pos AS depth, role, text FROM sized s JOIN own o ON o.conv_id = s.base AND o.pos <= s.h
  UNION ALL
  SELECT s.conv_id, o.pos - s.h + s.given, role, text FROM sized s JOIN own o USING (conv_id) WHERE o.pos > s.h),
paths AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         md5(string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS path
  FROM turns UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
steps AS MATERIALIZED (
  SELECT *, lag(path) OVER w AS above, lead(path) OVER w IS NULL AS ends
  FROM paths WINDOW w AS (PARTITION BY conv_id ORDER BY depth)),
nodes AS MATERIALIZED (
  SELECT path, min(depth) AS depth, min(above) AS above, min(words) AS words, min(conv_id) AS conv_id,
         count(*) AS n_convs, sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM steps GROUP BY path),
children AS (SELECT above AS path, count(*) AS n_children FROM nodes GROUP BY above),
below AS (
  SELECT s.path, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
  FROM nodes n JOIN steps s ON s.conv_id = n.conv_id AND s.depth <= n.depth LEFT JOIN children c ON c.path = n.path
  GROUP BY s.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (path) LEFT JOIN children c USING (path) LEFT JOIN nodes p ON p.path = n.above"""


def rebuilt(steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their depth after the exchange of first turns, and all conversations.

    Conversation c begins with the first h turns of c - c % 20 and goes on with its own after its
    first h; h is the checksum of its id modulo 4.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % HEADS
    convs = steps.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("h", h.cast("bigint"))
    convs, _ = keep(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY), "convs")
    given = convs.select("conv_id", "h", "base").join(
        convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left"
    )
    given = given.withColumn("given", F.least("h", F.coalesce("n_base", F.lit(0))))
    heads = steps.filter((F.col("pos") < HEADS) & (F.col("conv_id") % FAMILY == 0))
    first = (
        heads.withColumnRenamed("conv_id", "base")
        .join(given.select("conv_id", "base", "h"), "base")
        .filter("pos <= h")
        .select("conv_id", F.col("pos").alias("depth"), "code", "words")
    )
    rest = (
        steps.join(given.select("conv_id", "h", "given"), "conv_id")
        .filter("pos > h")
        .select("conv_id", F.expr("pos - h + given").alias("depth"), "code", "words")
    )
    turns, _ = keep(first.union(rest), "rebuilt")
    return turns, convs.select("conv_id")


@query(_TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie over the conversations with exchanged first turns."""
    return trie.nodes(*rebuilt(trie.steps(table(spark, sf_dir, "conversations"))))
