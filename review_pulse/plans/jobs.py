"""The jobs a user runs: curate, train, publish, score and read the dashboard."""

from __future__ import annotations

import functools
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from review_pulse import schemas
from review_pulse.functions import lexicon, text
from review_pulse.functions.labels import valid_labels, with_label
from review_pulse.operators import marts, metrics, models, profile
from review_pulse.sources import messages, tables
from review_pulse.streaming import late, refresh, scoring, versions


def _row_key() -> Column:
    """The id a review brought along, else a digest of all its fields, NULLs and rating included."""
    fields = F.struct("reviewerID", "asin", "reviewTime", "reviewText", F.col("overall").cast("string").alias("overall"))
    return F.coalesce(F.col("review_id"), F.md5(F.to_json(fields, {"ignoreNullFields": "false"}).cast("binary")))


def curate(raw: DataFrame) -> DataFrame:
    """Raw reviews to curated rows: cleaned, normalised, labelled, unlabelled rows dropped.

    Narrow throughout: no row leaves its partition. Texts are processed whole.
    """
    cleaned = raw.withColumn("cleaned_text", text.with_placeholder(text.clean_batch(F.col("reviewText"))))
    labelled = valid_labels(with_label(cleaned.withColumn("lemmatized_text", lexicon.lemmatize(F.col("cleaned_text")))))
    return labelled.select(
        _row_key().alias("review_id"),
        F.col("reviewerID").alias("reviewer_id"),
        "asin",
        F.col("reviewTime").alias("review_time"),
        F.col("overall").cast("double").alias("overall"),
        F.col("reviewText").alias("review_text"),
        "cleaned_text",
        "lemmatized_text",
        "label",
    )


def run_curate(spark: SparkSession, source: str, target: str, csv: str | None = None) -> None:
    raw = tables.read_reviews(spark, source)
    profile.null_profile(raw.drop(schemas.CORRUPT)).show(truncate=False)
    profile.rating_summary(raw).show(truncate=False)
    profile.histogram(raw).show()
    tables.write_curated(curate(raw), target)
    stored = tables.read_curated(spark, target)
    read, texts, malformed = raw.agg(F.count("*"), F.count("reviewText"), F.count(schemas.CORRUPT)).first()
    kept = stored.count()
    print(f"read {read}, malformed {malformed}, without text {read - texts}, kept {kept}, without a class {read - kept}")
    profile.class_distribution(stored).show()
    if csv:
        tables.write_csv(stored.select(*schemas.CURATED_CSV.names), csv)


def class_mix(curated: DataFrame, train: DataFrame, held_out: DataFrame) -> DataFrame:
    """Rows per class: of all curated rows, of the training rows as rebalanced, and of the other splits."""
    parts = [curated.select(F.lit("curated").alias("rows"), "label"), train.select(F.lit("train").alias("rows"), "label"),
             held_out.select(F.col("split").alias("rows"), "label")]
    every = functools.reduce(DataFrame.unionByName, [p.withColumn("label", F.col("label").cast("int")) for p in parts])
    return every.groupBy("rows", "label").agg(F.count("*").alias("n")).orderBy("rows", "label")


def run_train(
    spark: SparkSession, source: str, model_path: str, family: str = "svm",
    order: str = "split_first", test_export: str | None = None,
) -> models.Evaluation:
    """Fit, evaluate and save; the test rows are exported as messages that can be replayed."""
    curated = tables.read_curated(spark, source)
    train, held_out = models.training_splits(curated, order=order, rebalance=models.wants_rebalancing(family))
    model = models.fit(train, family)
    models.save(model, model_path)
    if test_export:
        test = held_out.where(F.col("split") == "test")
        tables.write_json_lines(test.select(*messages.message_columns(), "label"), f"{test_export}/json")
        tables.write_csv(test.select(*schemas.CURATED_CSV.names), f"{test_export}/csv")
    scored = models.score(model, held_out)
    result = models.evaluate(scored, "split")
    class_mix(curated, train, held_out).show()
    metrics.prediction_distribution(scored, "predicted_label").show()
    profile.preview(scored.select("review_id", "split", "label", "predicted_label", "lemmatized_text"), "review_id").show(truncate=False)
    result.confusion.orderBy("split", "label", "prediction").show()
    result.per_class.orderBy("split", "class").show()
    result.overall.orderBy("split").show()
    return result


def run_score(
    spark: SparkSession, models_base: str, target: str, marts_path: str, checkpoint: str,
    source_format: str = "text", model_name: str | None = None, quarantine: str | None = None,
    lemmatize: bool = False, trigger: dict | None = None, merge_every: int | None = None, **source_options: str,
):
    """Start scoring a message stream into the predictions table and its marts.

    With ``merge_every``, the folders of so many batches are merged, in the table and the marts.
    """
    if model_name is None:  # the version in use may change while the stream runs
        scorer = versions.scorer(models_base, target)
    else:
        scorer = scoring.model_scorer(models.resolve(spark, models_base, model_name)[1])
    stream = messages.read_stream(spark, source_format, **source_options)
    return scoring.score_stream(
        stream, scorer, target, checkpoint, quarantine=quarantine, versioned=model_name is None,
        normalise=scoring.lemmatized if lemmatize else text.clean_stream,
        after_batch=refresh.refresh(target, marts_path, merge_every), trigger=trigger,
        report=lambda batch_id, counts: print(f"batch {batch_id}: {counts}"),
    )


def run_trend(
    spark: SparkSession, predictions: str, target: str, checkpoint: str, lateness_hours: float = 24,
    horizon_days: float = 30, merge_every: int | None = None, trigger: dict | None = None,
) -> None:
    """Follow the batches a scoring stream stores and keep the trend that late rows correct."""
    stream = spark.readStream.schema(tables.STORED).option("basePath", predictions).parquet(f"{predictions}/stream=*/batch_id=*")
    scoring.await_all([late.start(
        stream, target, checkpoint, timedelta(hours=lateness_hours), timedelta(days=horizon_days),
        trigger=trigger, fan=merge_every)])
    late.trend(spark, target).orderBy("day").show(truncate=False)


def run_merge(spark: SparkSession, predictions: str, marts_path: str, everything: bool = False, vacuum: bool = False) -> None:
    """Merge stored batches and partial results; print what each store's newest generation has."""
    merged = {"predictions": tables.merge_predictions(spark, predictions, everything=everything)}
    merged |= refresh.merge_marts(spark, marts_path, everything=everything)
    for name, generation in merged.items():
        batches = sum(len(ids) for f in generation.folders for ids in f.batches.values())
        print(f"{name}: generation {generation.number}, {batches} batches in {len(generation.folders)} folders")
    if vacuum:
        print(f"deleted folders: {refresh.vacuum(spark, predictions, marts_path)}")


def dashboard(
    predictions: DataFrame, as_of: datetime | None = None, days_back: int = 7,
    limit: int = 10, asin: str | None = None,
) -> dict[str, DataFrame]:
    """Every dashboard query over a predictions table, by panel name."""
    moment = as_of if as_of is not None else marts.latest_moment(predictions)
    panels = {
        "sentiment_counts": marts.sentiment_counts(predictions),
        "sentiment_share": marts.sentiment_share(predictions),
        "sentiment_trend": marts.sentiment_trend(predictions, moment, days_back),
        "recent_reviews": marts.recent_reviews(predictions, limit),
        "top_reviewers": marts.top_reviewers(predictions, limit),
        "top_products": marts.top_products(predictions, limit),
        "store_stats": marts.store_stats(predictions),
    }
    if asin is not None:
        panels["product_sentiment"] = marts.product_sentiment(predictions, asin)
    return panels
