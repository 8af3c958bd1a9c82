"""Text cleaning and tokenisation expressions.

All of it is JVM-side: ``regexp_replace``, ``lower``, ``split`` and a
higher-order ``filter``; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: must equal the reference for the same tokens ---------
# Punctuation class replaced by a space.  Java regex, written as in the
# reference; the trailing " --" is a range U+0020..U+002D, so the class
# covers space ! " # $ % & ' ( ) * + , - . / : ; < = > ? @ [ \ ] ^ _ `
# { } ~ and U+2212 (but not "|", tabs or the em dash).
PUNCTUATION_CLASS = r"""[! @ # $ % ^ & * ( ) \[ \] . \\ / _ { } + - − , " ' ~ ; : ` ? = > < --]"""
# Words that contain an ASCII digit.
DIGIT_WORD = r"\w*\d\w*"
# A single ASCII letter (or comma) between two whitespace characters;
# applied twice so that runs like " a b " are removed too.
SINGLE_LETTER = r"\s[A-Z,a-z]\s"
# Whitespace split (one character; runs give empty tokens, dropped later).
SPLIT_PATTERN = r"\s"
# Token test: only letters, and every character in the Basic
# Multilingual Plane (Java's Character.isLetter on UTF-16 units).
LETTERS_ONLY = r"^[\p{L}&&[\x{0}-\x{FFFF}]]+$"
MIN_TOKEN_LENGTH = 4          # kept tokens are longer than 3 characters
# --- end of fixed values -------------------------------------------------


def strip_special_characters(text: Column) -> Column:
    """The four replacements, in order."""
    out = F.regexp_replace(text, PUNCTUATION_CLASS, " ")
    out = F.regexp_replace(out, DIGIT_WORD, " ")
    out = F.regexp_replace(out, SINGLE_LETTER, " ")
    return F.regexp_replace(out, SINGLE_LETTER, " ")


def split_words(text: Column) -> Column:
    """P14 + P15: lower-case, then split on single whitespace characters."""
    return F.split(F.lower(text), SPLIT_PATTERN)


def keep_token(stopwords: Iterable[str] | None = None):
    """P16 predicate for ``F.filter``: long enough, letters only, not a stopword.

    ``isin`` inside the lambda compiles to a hashed INSET, so the stop list
    costs O(1) per token.  Words that can never survive the other tests are
    dropped from the list first (they would only bloat the set).
    """
    words = usable_stopwords(stopwords or [])

    def pred(t: Column) -> Column:
        cond = (F.length(t) >= MIN_TOKEN_LENGTH) & t.rlike(LETTERS_ONLY)
        if words:
            cond = cond & ~t.isin(words)
        return cond

    return pred


def usable_stopwords(words: Iterable[str]) -> list[str]:
    """Stop words that could ever match a kept token (lower-case, long, letters)."""
    stripped = {(w or "").strip() for w in words}
    return sorted(w for w in stripped
                  if len(w) >= MIN_TOKEN_LENGTH and w.isalpha() and all(ord(c) <= 0xFFFF for c in w))


def tokenize(text: Column, stopwords: Iterable[str] | None = None) -> Column:
    """P13-P16 as one array<string> expression; null text gives an empty array."""
    cleaned = strip_special_characters(F.coalesce(text, F.lit("")))
    return F.filter(split_words(cleaned), keep_token(stopwords))


# A short list of common English function words, used by the registered
# queries when no stop-word file is given (any list can be passed instead,
# e.g. one read with ``sources.csv.read_stopwords``).
BASIC_STOPWORDS = [
    "about", "above", "after", "again", "against", "also", "because", "been",
    "before", "being", "below", "between", "both", "could", "does", "doing",
    "down", "during", "each", "from", "further", "have", "having", "here",
    "into", "more", "most", "other", "over", "same", "should", "some", "such",
    "than", "that", "their", "theirs", "them", "then", "there", "these",
    "they", "this", "those", "through", "under", "until", "very", "were",
    "what", "when", "where", "which", "while", "whom", "will", "with",
    "would", "your", "yours",
]
