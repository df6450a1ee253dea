"""Classification metrics, all derived from the confusion table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_matrix(scored: DataFrame, *by: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (actual, predicted); the only step that reads the scored rows."""
    pairs = scored.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return pairs.groupBy(
        *by, F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count("*").alias("n"))


def confusion_pivot(confusion: DataFrame, codes: list) -> DataFrame:
    """Display form with one column per predicted class."""
    return confusion.groupBy("label").pivot("prediction", codes).sum("n").fillna(0).orderBy("label")


def prediction_distribution(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(prediction).agg(F.count("*").alias("n")).orderBy(prediction)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def per_class(confusion: DataFrame, *by: str) -> DataFrame:
    """Precision, recall and F1 of every class that occurs among the actual labels.

    Each confusion cell is counted once for its actual and once for its predicted class, so the
    totals meet in one grouping without a join.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    roles = F.array(
        F.struct(F.col("label").cast("double").alias("class"), F.col("n").alias("actual"),
                 F.lit(0).cast("bigint").alias("predicted"), hit.cast("bigint").alias("hits")),
        F.struct(F.col("prediction").cast("double").alias("class"), F.lit(0).cast("bigint").alias("actual"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
    )
    totals = (
        confusion.select(*by, F.inline(roles))
        .groupBy(*by, "class")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
        .where(F.col("actual") > 0)
    )
    rates = totals.withColumns({
        "precision": _ratio(F.col("hits"), F.col("predicted")),
        "recall": _ratio(F.col("hits"), F.col("actual")),
    })
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rates.withColumn("f1", f1)


def overall(confusion: DataFrame, *by: str) -> DataFrame:
    """Accuracy, and precision / recall / F1 weighted by the actual class shares."""
    classes = per_class(confusion, *by)

    def weighted(name: str) -> Column:
        return _ratio(F.sum(F.col(name) * F.col("actual")), F.sum("actual")).alias(f"weighted_{name}")

    return classes.groupBy(*by).agg(
        _ratio(F.sum("hits"), F.sum("actual")).alias("accuracy"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
    )
