"""Small documents with the odd cases that every operator must take."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def prose(seed, n):
    """n invented words, the same for the same seed."""
    syllables = "ba ko ri ten lu sha mo ver di nu".split()
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        word = ""
        for _ in range(2 + x % 2):
            x = (x * 1103515245 + 12345) % (1 << 31)
            word += syllables[(x >> 8) % 10]
        out.append(word)
    return " ".join(out)


def odd_documents():
    """Null, empty, blank, symbols only, very long, repeated rows, repeated and null ids."""
    rows = [
        (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, "   \n", None, None, 3), (4, "?!*", "de", "s", 3),
        (5, "x" * 200_000, "en", "s", 200_000), (6, prose(1, 30_000), "en", "s", None),
        (7, prose(2, 60), "en", "s", None), (7, prose(2, 60), "en", "s", None), (8, prose(2, 60), "fr", "t", None),
        (9, prose(3, 60), "fr", None, None), (9, prose(4, 60), "fr", None, None), (None, prose(5, 40), "en", "s", None),
        (None, None, None, None, None), (10, "é漢字 😀 naïve ÀÉ", "fr", "s", 16), (11, "one", "en", "s", 3),
    ]
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)
