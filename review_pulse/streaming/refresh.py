"""Marts kept up to date batch by batch.

Each stored batch leaves its own small partial result; a dashboard query adds the partial results
up. The work per refresh follows the size of the batch, not of the history, and replaying a batch
replaces its partial result. Partial results of many batches are merged into one from time to time.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from review_pulse.functions.labels import CLASS_NAMES
from review_pulse.operators import marts, threshold
from review_pulse.schemas import MARTS
from review_pulse.sources.tables import merge_predictions, read_batch
from review_pulse.streaming import generations
from review_pulse.streaming.scoring import batch_path

# Fixed value: rows a pushed "recent reviews" panel shows; wider panels read the predictions.
RECENT_ROWS = 15

_TALLIES = [n.lower() for n in CLASS_NAMES.values()]


def daily_counts(predictions: DataFrame) -> DataFrame:
    """Rows, class counts and latest time per ingestion day; unscored rows count in ``stored``."""
    return predictions.groupBy(F.to_date(marts.MOMENT).alias("day")).agg(
        *marts.class_tallies(),
        F.count(marts.PREDICTED).alias("valid"),
        F.count("*").alias("stored"),
        F.max(marts.MOMENT).alias("latest"),
    )


def refresh(predictions_path: str, marts_path: str, fan: int | None = None):
    """A callback for :func:`score_stream` that writes the partial results of the stored batch.

    With ``fan``, folders of batches are merged when there are as many, in the store and in the marts.
    """

    def run(spark: SparkSession, stream: str, batch_id: int) -> None:
        batch = read_batch(spark, predictions_path, batch_path(predictions_path, stream, batch_id)).persist()
        try:
            refresh_from(batch, stream, batch_id, marts_path)
        finally:
            batch.unpersist()
        if fan:
            merge_predictions(spark, predictions_path, fan=fan)
            merge_marts(spark, marts_path, fan=fan)

    return run


def _newest(rows: DataFrame) -> DataFrame:
    return marts.newest(rows, RECENT_ROWS).select(*MARTS["recent"].names)


def merge_marts(spark: SparkSession, marts_path: str, **options) -> dict[str, generations.Generation]:
    """Merge the partial results of many batches: sums by day or key, and the newest rows of all."""
    combine = {
        "daily": generations.sums(["day"], [*_TALLIES, "valid", "stored"], ("latest",)),
        "reviewers": generations.sums(["reviewer_id"], [*_TALLIES, "total"]),
        "products": generations.sums(["asin"], [*_TALLIES, "total"]),
        "recent": _newest,
    }
    return {name: generations.merge(spark, f"{marts_path}/{name}", MARTS[name], step, **options)
            for name, step in combine.items()}


def vacuum(spark: SparkSession, predictions_path: str, marts_path: str, keep: int = 2) -> int:
    """Delete the folders that merging has left behind; gives their number."""
    paths = [predictions_path, *(f"{marts_path}/{name}" for name in MARTS)]
    return sum(generations.vacuum(spark, path, keep) for path in paths)


def refresh_from(batch: DataFrame, stream: str, batch_id: int, marts_path: str) -> None:
    partials = {
        "daily": daily_counts(batch),
        "reviewers": marts.tallies_by(batch, "reviewer_id"),
        "products": marts.tallies_by(batch, "asin"),
        "recent": _newest(batch),
    }
    for name, partial in partials.items():
        partial.write.mode("overwrite").parquet(batch_path(f"{marts_path}/{name}", stream, batch_id))


def _read(spark: SparkSession, marts_path: str, name: str, part: str | None = None) -> DataFrame:
    return generations.read(spark, f"{marts_path}/{name}", MARTS[name], part)


def sentiment_counts(spark: SparkSession, marts_path: str) -> DataFrame:
    daily = _read(spark, marts_path, "daily")
    sums = daily.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _TALLIES]
    )
    return marts.upright(sums)


def sentiment_trend(
    spark: SparkSession,
    predictions: DataFrame,
    marts_path: str,
    as_of: Column | datetime,
    days_back: int = 7,
) -> DataFrame:
    """Whole days from the daily partials; the two end days, which the range cuts, from the
    predictions of those days."""
    start, end = marts.trend_bounds(as_of, days_back)
    names = _TALLIES
    day = F.col("day")
    inner = (
        _read(spark, marts_path, "daily")
        .where((day > F.to_date(start)) & (day < F.to_date(end)))
        .select("day", *names)
    )
    cut = marts.in_range(marts.with_prediction(predictions), start, end)
    moment_day = F.to_date(marts.MOMENT)
    cut = cut.where((moment_day == F.to_date(start)) | (moment_day == F.to_date(end)))
    if "ingest_date" in predictions.columns:
        cut = cut.where(F.col("ingest_date").isin(F.to_date(start), F.to_date(end)))
    edges = cut.groupBy(moment_day.alias("day")).agg(*marts.class_tallies())
    daily = inner.unionByName(edges).groupBy("day").agg(*[F.sum(n).alias(n) for n in names])
    return marts.fill_days(daily, start, end)


def top_reviewers(spark: SparkSession, marts_path: str, limit: int = 10) -> DataFrame:
    """Few keys are summed over all batches: the batches' own counts rule out the others."""
    return threshold.top_keys(_read(spark, marts_path, "reviewers", part="part"), "reviewer_id", "part", limit)


def top_products(spark: SparkSession, marts_path: str, limit: int = 10) -> DataFrame:
    return threshold.top_keys(_read(spark, marts_path, "products", part="part"), "asin", "part", limit)


def product_sentiment(spark: SparkSession, marts_path: str, asin: str) -> DataFrame:
    names = [*_TALLIES, "total"]
    wanted = _read(spark, marts_path, "products").where(F.col("asin") == asin)
    sums = wanted.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    return marts.with_percentages(sums.select(F.lit(asin).alias("asin"), "*"))


def recent_reviews(spark: SparkSession, marts_path: str, limit: int = RECENT_ROWS) -> DataFrame:
    """The newest rows overall are among the newest of their batches (``limit`` up to 15)."""
    if limit > RECENT_ROWS:
        raise ValueError(f"the mart keeps {RECENT_ROWS} rows per batch")
    return marts.recent_reviews(_read(spark, marts_path, "recent"), limit)


def store_stats(spark: SparkSession, marts_path: str) -> DataFrame:
    totals = _read(spark, marts_path, "daily").agg(
        F.coalesce(F.sum("stored"), F.lit(0)).alias("total_predictions"),
        F.coalesce(F.sum("valid"), F.lit(0)).alias("valid_predictions"),
        F.max("latest").alias("latest"),
    )
    return marts.stats_row(totals)


def latest_moment(spark: SparkSession, marts_path: str) -> Column:
    """Most recent ingestion time, from the daily partials, as a scalar subquery."""
    return _read(spark, marts_path, "daily").agg(F.max("latest")).scalar()


def panels(
    spark: SparkSession,
    predictions: DataFrame,
    marts_path: str,
    as_of: Column | datetime | None = None,
    days_back: int = 7,
    limit: int = 10,
    asin: str | None = None,
) -> dict[str, DataFrame]:
    """Every dashboard panel from the partial results, by name."""
    moment = latest_moment(spark, marts_path) if as_of is None else as_of
    found = {
        "sentiment_counts": sentiment_counts(spark, marts_path),
        "sentiment_share": marts.shares(sentiment_counts(spark, marts_path)),
        "sentiment_trend": sentiment_trend(spark, predictions, marts_path, moment, days_back),
        "recent_reviews": recent_reviews(spark, marts_path, limit)
        if limit <= RECENT_ROWS else marts.recent_reviews(predictions, limit),
        "top_reviewers": top_reviewers(spark, marts_path, limit),
        "top_products": top_products(spark, marts_path, limit),
        "store_stats": store_stats(spark, marts_path),
    }
    if asin is not None:
        found["product_sentiment"] = product_sentiment(spark, marts_path, asin)
    return found
