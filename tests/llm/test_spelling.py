import random
import re
import zlib
from collections import Counter

import pytest

from millwatch.llm import spelling
from texts import LOWER, no_docs, odd_docs  # noqa: F401


def vocabulary(rows, every=97):
    found = Counter()
    for d, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", (text or "")):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if every and h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes b of a."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(words):
    out, forms, found = [], {}, {}
    for w, n in words.items():
        found[w] = [v for v in words if near(w, v)]
        best = min(found[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(found[w]), words[forms[w]] if forms[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("pairs", [0, 50, 4096])
def test_variants_against_brute_force(spark, monkeypatch, pairs):
    rng = random.Random(pairs)
    words = {}
    for _ in range(300):  # few letters and shared beginnings: keys that must be divided
        w = rng.choice(["", "inter", "aaaaa"]) + "".join(rng.choices("abé", k=rng.randrange(5, 9)))
        words[w] = rng.choice([3, 5, 12, 30, 70, 200])
    words["x" * 3000] = 4
    words["x" * 2999] = 9
    words["x" * 1500 + "y" + "x" * 1499] = 3
    frame = spark.createDataFrame([(w, n, 1) for w, n in words.items()], "word string, n bigint, key int")
    monkeypatch.setattr(spelling, "PAIRS", pairs)
    monkeypatch.setattr(spelling.near_words, "__defaults__", (pairs,))
    found = spelling.variants(frame)
    assert got(found) == brute(words)
    assert {r.root for r in found.collect()} <= set(words)


def test_vocabulary_of_documents(spark):
    rng = random.Random(4)
    letters = ["alpha", "Ünder", "straße", "naïve", "ALPHAS", "Éclair", "abcde", "abc", "b×c÷d", "don't"]
    rows = [(i, " ".join(rng.choices(letters, k=30)) + rng.choice(["", "—", "日本"])) for i in range(60)]
    rows += [(None, "alpha alpha"), (7, None), (8, ""), (3, "alpha, " * 400), (3, "alpha, " * 400)]
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id bigint, text string, n int, word string")
    for every in (97, 5, None):
        found = {r.word: r.n for r in spelling.vocabulary(docs, typo_every=every).collect()}
        assert found == vocabulary(rows, every)


def test_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert got(spelling.variants(spelling.vocabulary(odd_docs))) == brute(vocabulary(rows))
    assert spelling.variants(spelling.vocabulary(no_docs)).collect() == []


def test_roots_of_long_chains(spark):
    words = {"a" * k + "bcdef": 3 * 2**k for k in range(12)}
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert got(spelling.variants(frame)) == brute(words)
