"""Rating to sentiment-class expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Class codes and their display names.
NEGATIVE, NEUTRAL, POSITIVE = 0, 1, 2
CLASS_CODES = (NEGATIVE, NEUTRAL, POSITIVE)
CLASS_NAMES = {NEGATIVE: "Negative", NEUTRAL: "Neutral", POSITIVE: "Positive"}

# What counts as a number in text; Java alone would also take "5d" or "0x1p3".
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def parse_rating(text: Column) -> Column:
    """Rating held as text; anything that is not a number becomes NULL."""
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def rating_label(overall: Column) -> Column:
    """Below three stars negative, three neutral, above positive; NULL and NaN stay NULL."""
    return (
        F.when(F.isnan(overall), F.lit(None))
        .when(overall < 3, NEGATIVE)
        .when(overall == 3, NEUTRAL)
        .when(overall > 3, POSITIVE)
        .cast("int")
    )


def with_label(df: DataFrame, rating: str = "overall") -> DataFrame:
    """Add ``label``; a textual rating column is parsed first."""
    textual = dict(df.dtypes)[rating] == "string"
    number = parse_rating(F.col(rating)) if textual else F.col(rating).cast("double")
    return df.withColumn("label", rating_label(number))


def valid_labels(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows whose class code is one of the three; NULL and stray codes go."""
    return df.where(F.col(label).isin(*CLASS_CODES))


def sentiment_name(label: Column) -> Column:
    name = F.lit("Unknown")
    for code, text in reversed(CLASS_NAMES.items()):
        name = F.when(label == code, text).otherwise(name)
    return name
