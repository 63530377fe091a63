"""URL filter: pattern rules found through their rarest literal token.

A rule is a host with a path prefix; it fits the host and all its subdomains if the URL's path starts with the prefix.
A rule compiles to a regular expression over ``host + path``. Its literal tokens are the runs of
letters and digits in it that must occur as whole tokens in any URL it fits; of these the one
that fewest URLs have is the rule's index entry. A URL's distinct tokens fetch candidate
rules by a join, and only candidates run their expressions. A rule without such a token is a candidate for all URLs.

Of the rules that fit, the longest wins, a block before an allow, then by code point. Where none
fits, patterns over the whole host decide: hosts with a blocked word among their tokens are
blocked, others allowed.

Edge cases: null URLs and URLs without ``://`` have empty host and path, fit no rule and are allowed. Null and
repeated ids are kept, one row out per row in. No rules: only the fallback decides. Empty tables
give no rows. Columns besides id and URL are ignored; long URLs are matched whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# verdict, host, path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

BLOCKED_WORDS = (
    "spam", "pills", "casino", "bets", "adult", "xxx", "porn", "viagra", "warez", "track", "tracker", "phishing",
)

BROADCAST_RULES = 100_000
"""Candidates are joined by broadcast up to so many rules, by shuffle beyond."""

_TOKEN = "[^\\p{L}\\p{N}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s).*?://[^/?#]*([^?#]*)", 1)


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, _TOKEN), lambda t: t != ""))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``verdict, rule, pattern, literals`` of (verdict, host, path) rules."""
    rows = spark.createDataFrame([list(r) for r in rules], "verdict string, host string, path string")
    # Java quotes: everything between \Q and \E is literal
    quoted = F.concat(F.lit("\\Q"), F.replace(F.concat("host", "path"), F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    # a host ends where it ends; the last run of a path prefix may go on and is no whole token
    after = F.when(F.col("path") == "", F.lit("(?=/|\\z)")).otherwise(F.lit(""))
    open_end = F.regexp_replace(F.concat("host", "path"), "[\\p{L}\\p{N}]+$", "")
    whole = F.when(F.col("path") == "", F.col("host")).otherwise(open_end)
    return rows.select(
        "verdict",
        F.concat("host", "path").alias("rule"),
        F.concat(F.lit("^(?:[^/]*\\.)?"), quoted, after).alias("pattern"),
        _tokens(whole).alias("literals"),
    )


def index_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Adds ``token``, each rule's literal that fewest URLs have; null if it has none."""
    literals = rules.select("rule", "verdict", F.explode("literals").alias("token"))
    wanted = literals.select("token").distinct()
    counts = tokens.join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        literals.join(counts, "token", "left")
        .groupBy("rule", "verdict")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), F.col("token"))).alias("token"))
    )
    return rules.join(rarest, ["rule", "verdict"], "left")


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    blocked_words: Sequence[str] = BLOCKED_WORDS,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``."""
    spark = pages.sparkSession
    named = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    parts = named.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # equal addresses are judged once, which also levels a host with many pages
    addresses = parts.select("host", "path").distinct().filter("host <> ''")
    target = F.concat("host", "path")
    by_token = addresses.select("host", "path", F.explode(_tokens(target)).alias("token"))
    table = rule_table(spark, rules).cache()
    indexed = index_rules(table, by_token.select("token"))
    keep = ["token", "verdict", "rule", "pattern"]
    some = indexed.filter("token is not null").select(*keep)
    loose = indexed.filter("token is null").select(*keep)
    if len(rules) <= BROADCAST_RULES:
        some, loose = F.broadcast(some), F.broadcast(loose)
    candidates = by_token.join(some, "token").drop("token")
    everywhere = addresses.withColumn("token", F.lit("")).join(
        loose.withColumn("token", F.lit("")), "token"
    ).drop("token")
    fits = candidates.unionByName(everywhere).filter(F.regexp(target, F.col("pattern")))
    rank = F.struct(
        F.length("rule"), (F.col("verdict") == "block").cast("int"), F.col("rule"), F.col("verdict")
    )
    best = fits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    ruled = best.select(
        "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("ruled")
    )
    words = F.array(*[F.lit(w) for w in blocked_words]) if blocked_words else F.array().cast("array<string>")
    fallback = F.when(F.arrays_overlap(F.split("host", _TOKEN), words), "block").otherwise("allow")
    return parts.join(ruled, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", fallback).alias("verdict")
    )
