"""Small tables shared by the tests of the text operators."""

import re

import pytest

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# texts with every kind of oddity: null, empty, blank, short, long, repeated, beyond ASCII
ODD_TEXTS = [
    None, "", " \t\n", "one", "one two three four", "One two Three four FIVE six",
    "Éa ñu ß ö 日本 🙂 x", "word " * 30000, "a,b;c!! $$$ 123 'tis don't", "one", " \u0085 \x0b\x0c",
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, width=5):
    found = words(text)
    if not found:
        return frozenset()
    if len(found) < width:
        return frozenset([tuple(found)])
    return frozenset(zip(*[found[i:] for i in range(width)], strict=False))


@pytest.fixture
def odd_docs(spark):
    """Documents with odd texts, a null id, a repeated id, and columns that clash with inner names."""
    rows = [(i, t, "x", None, None) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "null id text here now", None, "en", 3), (3, "one", "y", "en", 3), (3, "other words", "y", "fr", 1)]
    return spark.createDataFrame(
        [(*r, 1, "k", 2.0, "m", 9, "h") for r in rows],
        "doc_id bigint, text string, source string, lang string, n_chars bigint, "
        "cls bigint, key string, x double, mark string, part bigint, file string",
    )


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
