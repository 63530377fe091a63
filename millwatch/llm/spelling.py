"""Spelling variants: asymmetric q-chunks find the words at an edit distance of exactly one.

Of two words at distance one, the one with fewer code points (of equal ones the lower) contributes two disjoint chunks, its
halves; the other contributes positional grams. One edit touches one half at most, so the other half is a
gram of the longer word, at the same place if it is the first and shifted by the difference of the lengths, nought or
one, if it is the last. Grams at other places or of other lengths can join no chunk and are not made.
Both sides meet on a hash of lengths, place and letters, and pairs that meet are verified by their distance.

Common chunks ("inter", "tion") would pair thousands with thousands. A key whose pairs exceed
``PAIRS`` is not joined but divided: what is left of its words, the half with the edit, is halved the same way, and
what is preserved of it joins the key. This goes on until the keys are small or a single code point is left, where
the words of a key differ in one place only. Nothing is dropped, and the number of rounds grows with
the logarithm of the longest word.

A word's form is the most frequent of its near words (ties: the lowest in code-point order) if that is at least
``RATIO`` times as frequent. Roots are found by doubling the distance that every word has followed its forms.

Edge cases: null texts have no words, null ids count as empty text in the checksum; documents of one id
each count, also if they are equal. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import keep, remove

MIN_LETTERS = 5
MIN_COUNT = 3
RATIO = 2
PAIRS = 4096
"""Pairs that may meet on a key; keys with more are divided."""
TYPO_EVERY = 97

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    typo_every: int | None = TYPO_EVERY,
) -> DataFrame:
    """``word, n`` over whole texts. With ``typo_every`` one occurrence in so many loses a letter.

    Occurrences are counted before their exchange, so no word is a hot key.
    """
    letters = F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{min_letters},}}")
    runs = F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), letters, F.lit(0))
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"))
    words = docs.select(name.alias("name"), F.explode(runs).alias("run"))
    word = F.col("run")
    if typo_every:
        h = F.crc32(F.concat("name", "run").cast("binary"))
        at = (h % F.char_length("run")).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        word = F.when(h % typo_every == 0, shorter).otherwise(word)
    counted = words.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") >= min_count) & (F.char_length("word") >= min_letters))


def _key(shift: Column) -> Column:
    """Hash of what a word preserves outside ``[lo, hi)``; the longer word's hole is wider by ``shift``."""
    head = F.substring("word", F.lit(1), F.col("lo"))
    tail = F.substring("word", F.col("hi") + shift + 1, F.char_length("word"))
    return F.xxhash64("size", "lo", "hi", head, tail)


def _sides(words: DataFrame) -> DataFrame:
    """Chunk rows (``shift`` null) and gram rows of the words, with nothing preserved yet.

    ``size`` is the length of the word with the chunks, ``lo`` and ``hi`` the part of it with the edit.
    """
    size = F.char_length("word")
    roles = F.array(
        F.struct(size.alias("size"), F.lit(None).cast("int").alias("shift")),
        F.struct(size.alias("size"), F.lit(0).alias("shift")),
        F.struct((size - 1).alias("size"), F.lit(1).alias("shift")),
    )
    rows = words.select("word", "n", F.inline(roles))
    return rows.select("*", F.lit(0).alias("lo"), F.col("size").alias("hi"))


def _halved(rows: DataFrame) -> DataFrame:
    """Every row as two, with the edit in one half of its part or in the other."""
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    parts = F.array(
        F.struct(F.col("lo").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("hi").alias("b"))
    )
    cut = rows.select("word", "n", "size", "shift", F.inline(parts))
    cut = cut.withColumnsRenamed({"a": "lo", "b": "hi"})
    return cut.withColumn("key", _key(F.coalesce("shift", F.lit(0))))


def near_words(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """``a, n_a, b, n_b``: every pair of ``word, n`` at distance one, once; stored."""
    spark = words.sparkSession
    rows, found, used = _sides(words), None, []
    while True:
        sides, sides_at = keep(_halved(rows), "sides")
        chunk = F.col("shift").isNull()
        counts = sides.groupBy("key").agg(
            F.count_if(chunk).alias("chunks"), F.count_if(~chunk).alias("grams"),
            F.max(F.col("hi") - F.col("lo")).alias("left"),
        )
        live = counts.filter("chunks > 0 and grams > 0")
        fits = (F.col("chunks") * F.col("grams") <= pairs) | (F.col("left") <= 1)
        keys, keys_at = keep(live.select("key", fits.alias("fits")), "keys")
        few = sides.join(keys.filter("fits").select("key"), "key")
        u = few.filter(chunk).select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
        v = few.filter(~chunk).select("key", F.col("word").alias("b"), F.col("n").alias("n_b"), "shift")
        once = (F.col("shift") == 1) | (F.col("a") < F.col("b"))
        met = u.join(v, (u["key"] == v["key"]) & once & (F.levenshtein("a", "b", 1) == 1))
        near, near_at = keep(met.select("a", "n_a", "b", "n_b").distinct(), "near")
        found = near if found is None else found.union(near)
        used += [sides_at, keys_at, near_at]
        if keys.filter("not fits").isEmpty():
            break
        rows = sides.join(keys.filter("not fits").select("key"), "key", "left_semi")
    whole, _ = keep(found.distinct(), "near")
    remove(spark, *used)
    return whole


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``word, n``."""
    spark = words.sparkSession
    words, _ = keep(words.select("word", "n"), "words")
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")),
    )
    first = F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("first")
    best = near_words(words).select(F.inline(both)).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), first
    )
    has_form = -F.col("first.m") >= ratio * F.col("n")
    formed, _ = keep(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(has_form, F.col("first.other")).alias("form"),
            F.when(has_form, -F.col("first.m")).alias("form_n"),
        ),
        "forms",
    )
    links, path = keep(formed.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved, new_path = keep(links.join(ahead, "root", "left"), "roots")
        ended = moved.filter("further is not null").isEmpty()
        links = moved.select("word", F.coalesce("further", "root").alias("root"))
        remove(spark, path)
        path = new_path
        if ended:
            break
        links, path = keep(links, "roots")
        remove(spark, new_path)
    roots = formed.join(links, "word", "left")
    return roots.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
