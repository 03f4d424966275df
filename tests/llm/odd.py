"""Tables with the awkward rows that every operator must take."""

from __future__ import annotations

import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, Kept string, spans string, removed int"
LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit " * 6000
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def odd_documents(spark):
    """Nulls everywhere, empty and blank texts, a very long one, repeated rows, ties."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs far away.", "en", "a", 62, "x", "y", 1),
        (1, "The quick brown fox jumps over the lazy dog and runs far away.", "en", "a", 62, "x", "y", 1),
        (2, None, "en", "a", None, None, None, None),
        (3, "", None, None, 0, None, None, None),
        (4, " \n\t\r\n ", "en", "b", 6, None, None, None),
        (5, LONG, "en", "b", len(LONG), None, None, None),
        (None, "A text without an id, write to who@where.com or not.", "en", None, 50, None, None, None),
        (None, None, None, None, None, None, None, None),
        (6, "one", "en", "a", 3, None, None, None),
        (7, "one two", "en", "a", 7, None, None, None),
        (8, "The quick brown fox jumps over the lazy dog and runs far away.", "de", "c", 62, None, None, None),
        (9, "été ñandú \U0001f600 <|endoftext|> it's 1234 \x00 \x85 x", "fr", "c", 40, None, None, None),
        (10, "### $$$ *** &&& %%% ||| <<< >>> ### $$$ ***", "en", "a", 40, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORDS.findall(text or "")


def lower_words(text):
    return WORDS.findall((text or "").translate(LOWER))
