"""Review messages: JSON encoding, decoding with quarantine, stream sources and publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from review_pulse import schemas
from review_pulse.functions import display


def message_columns() -> list[Column]:
    """Curated or fixture columns under the names the message carries."""
    return [
        F.col("review_text").alias("reviewText"),
        F.col("overall").cast("float").alias("overall"),
        F.col("review_time").alias("reviewTime"),
        F.col("reviewer_id").alias("reviewerID"),
        F.col("asin"),
        F.col("review_id"),
    ]


def encode(reviews: DataFrame) -> DataFrame:
    """One JSON document per row, in a single ``value`` column."""
    return reviews.select(F.to_json(F.struct(*message_columns())).alias("value"))


def decode(messages: DataFrame, *keep: str) -> DataFrame:
    """Fields of each JSON ``value``, and whether the payload was NULL or blank; columns ``keep`` stay.

    Malformed text gives an all-NULL row that keeps the original in ``_corrupt_record``; a
    wrong-typed field gives NULL for that field, and keeps the original as well.

    The fields come out of a generator: a later filter on one of them would otherwise be pushed
    below the projection and parse every message a second time.
    """
    payload = F.from_json(
        F.col("value").cast("string"),
        schemas.MESSAGE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT},
    )
    blank = F.coalesce(F.trim(F.col("value").cast("string")) == "", F.lit(True))
    return messages.select(*keep, blank.alias(schemas.MISSING), F.inline(F.array(payload)))


def malformed() -> Column:
    """The payload is no JSON object. Only originals that were kept are looked at again."""
    original = F.col(schemas.CORRUPT)
    return original.isNotNull() & F.from_json(original, "map<string,string>").isNull()


def wrong_typed() -> Column:
    """A JSON object of which a field does not have its type."""
    return F.col(schemas.CORRUPT).isNotNull() & ~malformed()


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where(malformed())


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(~malformed() & ~F.col(schemas.MISSING)).drop(schemas.CORRUPT, schemas.MISSING)


def message_counts() -> list[Column]:
    missing = F.col(schemas.MISSING)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(~malformed() & ~missing).alias("sent"),
        F.count_if(malformed()).alias("errors"),
        F.count_if(wrong_typed()).alias("wrong_typed"),
        F.count_if(missing).alias("missing"),
    ]


def ingest_stats(decoded: DataFrame) -> DataFrame:
    """Messages read, accepted (of these, with a field of the wrong type), malformed and without a
    payload, and the success share in percent."""
    counts = decoded.agg(*message_counts())
    return counts.withColumn("success_pct", display.percent(F.col("sent"), F.col("total")))


def message_previews(decoded: DataFrame) -> DataFrame:
    """What an operator sees per message, with N/A for missing fields."""
    return decoded.select(
        F.col("review_id"),
        display.or_not_available(F.col("reviewerID")).alias("reviewer_id"),
        display.or_not_available(F.col("asin")).alias("asin"),
        display.or_not_available(F.col("overall")).alias("rating"),
        display.preview(F.col("reviewText")).alias("preview"),
    )


def read_stream(spark: SparkSession, source_format: str = "text", **options: str) -> DataFrame:
    """Message stream with a ``value`` column.

    ``text`` follows a folder of JSON lines (``path=...``); ``kafka`` takes the connector's own
    options, starting at the latest offsets unless told otherwise.
    """
    if source_format == "kafka":
        options = {"startingOffsets": "latest", **options}
    return spark.readStream.format(source_format).options(**options).load().select("value")


def publish(reviews: DataFrame, target_format: str = "text", **options: str) -> None:
    """Write every review as one message: JSON lines in a folder, or a Kafka topic."""
    encode(reviews).write.format(target_format).options(**options).mode("append").save()
