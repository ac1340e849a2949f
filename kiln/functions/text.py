"""Text column expressions (P11, P18, V-style scans) and tokenisation.

Regular expressions run in Java. Python's ``\\w``, ``\\s`` and ``\\d`` are
Unicode-aware; the Java equivalents need ``(?U)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def length(c: Column) -> Column:
    """Number of characters (pandas ``str.len``)."""
    return F.char_length(c).cast("bigint")


def word_count(c: Column) -> Column:
    """Whitespace-separated word count; blank text gives 0.

    ``size(split(''))`` would be 1, so the blank case is guarded.
    """
    t = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.when(c.isNull(), F.lit(None).cast("bigint")).when(t == "", F.lit(0)).otherwise(
        F.size(F.split(t, " "))
    ).cast("bigint")


def normalize_text(c: Column) -> Column:
    """Lower-case, keep ASCII letters and whitespace, collapse blanks."""
    t = F.regexp_replace(F.lower(c), r"(?U)[^a-zA-Z\s]", "")
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def tokens(c: Column, pattern: str = r"(?U)\b\w\w+\b") -> Column:
    """Lower-cased tokens of two or more word characters (vectorizer default)."""
    return F.regexp_extract_all(F.lower(c), F.lit(pattern), 0)


# Tokens of letters-only lower-case text: maximal runs of two or more letters.
ASCII_TOKEN_PATTERN = r"[a-z]{2,}"


def letters_only(c: Column) -> Column:
    """Lower-case, drop everything but ASCII letters and whitespace -- the
    text of ``normalize_text`` before its whitespace runs are collapsed.
    Token extraction does not depend on whitespace runs, so vectorisers use
    this cheaper form; on it ``ASCII_TOKEN_PATTERN`` finds exactly the tokens
    of the Unicode ``\\b\\w\\w+\\b`` pattern."""
    return F.regexp_replace(F.lower(c), r"(?U)[^a-zA-Z\s]", "")
