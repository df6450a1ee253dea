"""Data profile: rating summary, histograms, missing values, class counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_pulse.operators import selection


def rating_summary(df: DataFrame, rating: str = "overall") -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles of a column."""
    stats = selection.present(df, rating).agg(
        F.count(rating).alias("n"),
        F.avg(rating).alias("mean"),
        F.stddev_samp(rating).alias("std"),
        F.min(rating).alias("min"),
        F.max(rating).alias("max"),
    )
    quartiles = selection.quantiles(df, rating, [0.25, 0.5, 0.75])
    named = [F.lit(q).cast("double").alias(name) for name, q in zip(("q25", "q50", "q75"), quartiles)]
    return stats.select("n", "mean", "std", "min", *named, "max")


def histogram(df: DataFrame, column: str = "overall") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(column)


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its number of missing values (NaN counts on float columns)."""
    def missing(name: str, kind: str):
        empty = F.col(name).isNull()
        if kind in ("float", "double"):
            empty = empty | F.isnan(F.col(name))
        return F.count_if(empty).alias(name)

    counts = df.agg(*[missing(name, kind) for name, kind in df.dtypes])
    return counts.unpivot([], df.columns, "column_name", "n_missing")


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(label)


def empty_text_audit(df: DataFrame, text: str = "cleaned_text") -> DataFrame:
    return df.agg(F.count("*").alias("n_texts"), F.count_if(F.col(text) == "").alias("n_empty"))


def preview(df: DataFrame, order: str, rows: int = 5, width: int = 30) -> DataFrame:
    """The first rows by a column, as text of at most ``width`` characters: a heap per task, no full sort."""
    def shown(name: str):
        text = F.col(name).cast("string")
        return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width - 3), F.lit("..."))).otherwise(text).alias(name)

    return df.orderBy(order).limit(rows).select(*[shown(name) for name in df.columns])
