"""Dashboard marts over the predictions table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_pulse.functions import display
from review_pulse.functions.labels import CLASS_NAMES, sentiment_name

PREDICTED = "predicted_label"
MOMENT = "ingestion_time"


def with_prediction(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col(PREDICTED).isNotNull())


def class_tallies(alias: str = PREDICTED) -> list[Column]:
    """Conditional counts per class, in one pass."""
    return [
        F.count_if(F.col(alias) == code).alias(name.lower()) for code, name in CLASS_NAMES.items()
    ]


def with_percentages(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        f"{name.lower()}_pct": display.percent(F.col(name.lower()), F.col("total"))
        for name in CLASS_NAMES.values()
    })


def upright(tallies: DataFrame) -> DataFrame:
    """One row of class counts turned into three: class code, name, reviews, and the total."""
    total = sum((F.col(name.lower()) for name in CLASS_NAMES.values()), F.lit(0))
    rows = [
        F.struct(F.lit(code).alias("label"), F.lit(name).alias("sentiment"),
                 F.col(name.lower()).alias("reviews"))
        for code, name in CLASS_NAMES.items()
    ]
    return tallies.select(total.cast("bigint").alias("total"), F.inline(F.array(*rows))).select(
        "label", "sentiment", "reviews", "total"
    )


def sentiment_counts(predictions: DataFrame) -> DataFrame:
    """Always three rows: class code, name, number of reviews, and the total over the classes.

    One conditional aggregate, so no class list has to be joined; stray codes count nowhere.
    """
    return upright(with_prediction(predictions).agg(*class_tallies()))


def shares(counts: DataFrame) -> DataFrame:
    """Share of each class in percent; NULL when there are no predictions at all."""
    share = F.when(F.col("total") > 0, display.percent(F.col("reviews"), F.col("total")))
    return counts.select("label", "sentiment", share.alias("share_pct"))


def sentiment_share(predictions: DataFrame) -> DataFrame:
    return shares(sentiment_counts(predictions))


def trend_bounds(as_of: Column | datetime, days_back: int) -> tuple[Column, Column]:
    end = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return end - F.make_dt_interval(days=F.lit(days_back)), end


def in_range(predictions: DataFrame, start: Column, end: Column) -> DataFrame:
    """Both ends inclusive, time of day kept; prunes ``ingest_date`` folders where they exist."""
    moment_type = predictions.schema[MOMENT].dataType
    start, end = start.cast(moment_type), end.cast(moment_type)
    if "ingest_date" in predictions.columns:
        predictions = predictions.where(F.col("ingest_date").between(F.to_date(start), F.to_date(end)))
    return predictions.where(F.col(MOMENT).between(start, end))


def fill_days(daily: DataFrame, start: Column, end: Column) -> DataFrame:
    """One row per calendar day of the range, zero where ``daily`` has none.

    ``daily`` holds at most one row per day of the range, which bounds the broadcast.
    """
    days = daily.sparkSession.range(1).select(
        F.explode(F.sequence(F.to_date(start), F.to_date(end), F.make_dt_interval(days=F.lit(1)))).alias("day")
    )
    counts = [
        F.coalesce(F.col(name.lower()), F.lit(0)).cast("bigint").alias(name.lower())
        for name in CLASS_NAMES.values()
    ]
    return (
        days.join(F.broadcast(daily), "day", "left")
        .select(display.display_day(F.col("day")).alias("day"), *counts)
        .orderBy("day")
    )


def sentiment_trend(predictions: DataFrame, as_of: Column | datetime, days_back: int = 7) -> DataFrame:
    """Daily class counts for the ``days_back + 1`` calendar days that end at ``as_of``."""
    start, end = trend_bounds(as_of, days_back)
    recent = in_range(with_prediction(predictions), start, end)
    daily = recent.groupBy(F.to_date(MOMENT).alias("day")).agg(*class_tallies())
    return fill_days(daily, start, end)


def latest_moment(predictions: DataFrame) -> Column:
    """Most recent ingestion time as a scalar subquery, usable as ``as_of``."""
    return predictions.agg(F.max(MOMENT)).scalar()


def top_of(counts: DataFrame, key: str, limit: int = 10, min_reviews: int = 2) -> DataFrame:
    kept = counts.where(F.col(key).isNotNull() & (F.col("total") >= min_reviews))
    return with_percentages(kept.orderBy(F.desc("total"), F.asc(key)).limit(limit))


def tallies_by(predictions: DataFrame, key: str) -> DataFrame:
    """Class counts per key; partial aggregation keeps a hot key to one row per task."""
    return with_prediction(predictions).groupBy(key).agg(*class_tallies(), F.count("*").alias("total"))


def summed(partials: DataFrame, key: str) -> DataFrame:
    """Class counts per key from partial counts."""
    return partials.groupBy(key).agg(*[F.sum(n).alias(n) for n in (*(n.lower() for n in CLASS_NAMES.values()), "total")])


def top_keys(predictions: DataFrame, key: str, limit: int = 10, min_reviews: int = 2) -> DataFrame:
    """The keys with most reviews (two at least), with counts and percentages per class."""
    return top_of(tallies_by(predictions, key), key, limit, min_reviews)


def top_reviewers(predictions: DataFrame, limit: int = 10) -> DataFrame:
    return top_keys(predictions, "reviewer_id", limit)


def top_products(predictions: DataFrame, limit: int = 10) -> DataFrame:
    return top_keys(predictions, "asin", limit)


def product_sentiment(predictions: DataFrame, asin: str) -> DataFrame:
    """One row for one product, zeros when it has no predictions."""
    counts = (
        with_prediction(predictions)
        .where(F.col("asin") == asin)
        .agg(*class_tallies(), F.count("*").alias("total"))
    )
    return with_percentages(counts.select(F.lit(asin).alias("asin"), "*"))


def latest_prediction(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.max(MOMENT).alias("latest"))


def store_stats(predictions: DataFrame) -> DataFrame:
    """Row count, rows with a prediction and latest time, in one scan."""
    stats = predictions.agg(
        F.count("*").alias("total_predictions"),
        F.count(PREDICTED).alias("valid_predictions"),
        F.max(MOMENT).alias("latest"),
    )
    return stats_row(stats)


def stats_row(totals: DataFrame) -> DataFrame:
    return totals.select(
        "total_predictions",
        "valid_predictions",
        display.display_time(F.col("latest"), missing="None").alias("latest_prediction"),
        F.lit("connected").alias("connection_status"),
    )


def newest(predictions: DataFrame, limit: int = 10) -> DataFrame:
    """The most recent scored rows, ties broken by id: a bounded heap per task, no full sort."""
    return with_prediction(predictions).orderBy(F.desc(MOMENT), F.asc("review_id")).limit(limit)


def newest_with_text(predictions: DataFrame, limit: int = 10) -> DataFrame:
    """As :func:`newest`, for tables that carry the texts.

    The time of the last row to show is found on the narrow columns first; the texts are then read
    only from that time on, which prunes day folders and row groups. Rows without a time rank last.
    """
    scored = with_prediction(predictions)
    times = scored.select(MOMENT).orderBy(F.desc_nulls_last(MOMENT)).limit(limit)
    oldest = times.agg(F.min(MOMENT)).scalar()
    recent = scored.where(F.col(MOMENT) >= oldest)
    if "ingest_date" in predictions.columns:
        recent = recent.where(F.col("ingest_date") >= F.to_date(oldest))
    return newest(recent.unionByName(scored.where(F.col(MOMENT).isNull())), limit)


def recent_reviews(
    predictions: DataFrame,
    limit: int = 10,
    texts: DataFrame | None = None,
    lookup: Callable[[list[str]], DataFrame] | None = None,
) -> DataFrame:
    """Most recent reviews with readable time, class name and a text snippet.

    Where the predictions lack the text, ``texts`` (``review_id, lemmatized_text``, one row per id) is joined
    with the ``limit`` chosen rows, which are what is broadcast; or ``lookup`` gets their ids and gives
    their texts, so that it can read just what holds them.
    """
    if texts is None and lookup is None:
        chosen = newest_with_text(predictions, limit)
    else:
        chosen = newest(predictions, limit)
        if lookup:
            rows = chosen.collect()  # ``limit`` rows
            chosen = predictions.sparkSession.createDataFrame(rows, chosen.schema)
            texts = lookup([r["review_id"] for r in rows])
        else:
            texts = texts.join(F.broadcast(chosen.select("review_id")), "review_id", "left_semi")
        chosen = chosen.join(texts, "review_id", "left")
    return chosen.orderBy(F.desc(MOMENT), F.asc("review_id")).select(
        "review_id",
        "reviewer_id",
        PREDICTED,
        sentiment_name(F.col(PREDICTED)).alias("sentiment"),
        display.display_time(F.col(MOMENT)).alias("ingestion_time"),
        display.snippet(F.col("lemmatized_text")).alias("lemmatized_text"),
    )
