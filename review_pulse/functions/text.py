"""Text cleaning, token and n-gram expressions."""

from __future__ import annotations

from string import ascii_letters

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 whitespace characters of Python's \s, as the body of a Java regex class.
WHITESPACE = r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\p{Z}"

# Letters are listed one by one: Java tests single characters through a bit table, but a class of
# several ranges through a chain of predicates, which is ten times slower on long texts.
NOT_LETTER_OR_SPACE = f"[^{ascii_letters}{WHITESPACE}]+"

# Placeholder for texts that are empty after cleaning, and the character cap.
EMPTY_PLACEHOLDER = "no text available"
MAX_CHARS = 100_000


def _letters_and_single_spaces(text: Column) -> Column:
    # Once only letters and whitespace are left, whitespace is what is not a letter. Spark's trim
    # only strips U+0020, so whitespace is collapsed first.
    kept = F.regexp_replace(text, NOT_LETTER_OR_SPACE, "")
    return F.trim(F.regexp_replace(kept, "[^a-zA-Z]+", " "))


def clean_batch(text: Column) -> Column:
    """Letters and single spaces only, lower case. Missing text becomes ''."""
    return F.lower(_letters_and_single_spaces(F.coalesce(text, F.lit(""))))


def clean_stream(text: Column) -> Column:
    """As :func:`clean_batch`, but lower-cased first, so letters whose lower case is ASCII survive."""
    return _letters_and_single_spaces(F.lower(F.coalesce(text, F.lit(""))))


def with_placeholder(cleaned: Column) -> Column:
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(EMPTY_PLACEHOLDER))


def cap(text: Column, chars: int = MAX_CHARS) -> Column:
    return F.substring(text, 1, chars)


def tokens(text: Column) -> Column:
    """Lower-cased words split at whitespace; '' gives ['']."""
    return F.split(F.lower(text), f"[{WHITESPACE}]")


def cleaned_words(cleaned: Column) -> Column:
    """Words of a cleaned text; the literal separator spares compiling a pattern per row."""
    return F.split(cleaned, " ")


def without_stop_words(words: Column, stop_words: list[str]) -> Column:
    """Keep the words outside the (lower-case) list; a literal list is probed as a hash set."""
    return F.filter(words, lambda w: ~F.lower(w).isin(stop_words))


def ngrams(words: Column, n: int) -> Column:
    """Space-joined runs of ``n`` neighbouring words; empty when there are fewer."""
    starts = F.sequence(F.lit(1), F.size(words) - F.lit(n - 1))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))
