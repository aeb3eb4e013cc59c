"""Mail and word expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common words left out of the term statistics.
STOP_WORDS = [
    "the", "i", "a", "an", "at", "are", "am", "for", "and", "or", "is",
    "there", "it", "this", "that", "on", "was", "by", "of", "to", "in",
    "message", "not", "be", "with", "you", "have", "as", "can",
]

# A token of letters only, between white space: a token with any other character has no match.
_SPACE = " \\t\\n\\r\\f"
WORD = f"(?<![^{_SPACE}])[a-z]++(?![^{_SPACE}])"


def month(time: Column) -> Column:
    return F.substring(time, 1, 7)


def email_address(sender: Column) -> Column:
    """Text after the last ``<`` without the final character; the same cut if there is no ``<``."""
    address = F.substring_index(sender, "<", -1)
    return F.substring(address, F.lit(1), F.length(address) - 1)


def words(text: Column) -> Column:
    """Lower-case words of letters only; a token with any other character is dropped whole."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def tokens(text: Column, stop_words: list[str] | None = None) -> Column:
    """``words`` without the common ones."""
    stop = STOP_WORDS if stop_words is None else stop_words
    return F.filter(words(text), lambda w: ~w.isin(stop)) if stop else words(text)


def tf_idf_weight(tf: Column, df: Column, documents: Column) -> Column:
    """Plain ``tf * (N / df)``, no logarithm."""
    return tf * (documents.cast("double") / df)
