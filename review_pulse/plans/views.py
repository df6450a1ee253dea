"""Review-shaped views over the benchmark tables ``events`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_pulse.functions.labels import NEUTRAL, rating_label
from review_pulse.plans.jobs import curate
from review_pulse.sources import messages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # days are UTC days
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a rated review without text."""
    stars = 5 - F.least(F.lit(4), F.floor(F.col("value") / 25))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("review_id"),
        F.col("user_id").cast("string").alias("reviewer_id"),
        F.get_json_object("props", "$.k").alias("asin"),
        stars.cast("double").alias("overall"),
        F.col("ts"),
        F.col("event_id"),
        F.col("event_type"),
        F.col("props"),
    ).withColumn("label", rating_label(F.col("overall")))


def all_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a rated review, with the document of its id as text; most have none."""
    texts = documents(spark, sf_dir).select(
        F.col("doc_id").alias("event_id"), F.col("text").alias("review_text"), "lang", "source"
    )
    return ratings(spark, sf_dir).join(texts, "event_id", "left").withColumn(
        "review_time", F.date_format("ts", "yyyy-MM-dd")
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated reviews that have a text, for the models."""
    return all_reviews(spark, sf_dir).where(F.col("review_text").isNotNull())


def predictions(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Every event as a stored prediction, with gaps and disagreements; ``more`` columns of its rating stay."""
    predicted = (
        F.when(F.col("event_type") == "error", F.lit(None))
        .when(F.col("event_id") % 7 == 0, NEUTRAL)
        .otherwise(F.col("label"))
        .cast("int")
    )
    return ratings(spark, sf_dir).select(
        "review_id", "reviewer_id", "asin", "label",
        predicted.alias("predicted_label"), F.col("ts").alias("ingestion_time"), *more,
    )


def texts_of(spark: SparkSession, sf_dir: str, review_ids: list[str]) -> DataFrame:
    """Texts of a few reviews. The key stays a number, so that the scan can skip what cannot hold it."""
    rows = documents(spark, sf_dir).where(F.col("doc_id").isin([int(i) for i in review_ids]))
    return rows.select(F.col("doc_id").cast("string").alias("review_id"), F.col("text").alias("lemmatized_text"))


def payloads(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Reviews as JSON messages; of each 50 ids one arrives cut short, one with a rating that is no
    number, and one without a payload. ``more`` columns of the review stay."""
    columns = messages.message_columns()
    body = F.to_json(F.struct(*columns))
    columns[1] = F.lit("bad").alias("overall")
    kind = F.col("event_id") % 50
    value = F.when(kind == 0, F.substring(body, 1, 10)).when(kind == 1, F.to_json(F.struct(*columns))).when(
        kind == 2, F.lit(None)).otherwise(body)
    return all_reviews(spark, sf_dir).select(value.alias("value"), *more)


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with a text, in the curated form."""
    return _curated(reviews(spark, sf_dir))


def all_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every review in the curated form."""
    return _curated(all_reviews(spark, sf_dir))


def _curated(rated: DataFrame) -> DataFrame:
    raw = rated.select(*messages.message_columns()).withColumn(
        "overall", F.col("overall").cast("double")
    )
    return curate(raw)
