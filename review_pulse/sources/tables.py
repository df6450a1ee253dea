"""Batch readers and writers for reviews, curated rows and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_pulse import schemas
from review_pulse.functions.labels import parse_rating
from review_pulse.streaming import generations


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Raw reviews from JSON lines under a fixed schema; bad lines land in ``_corrupt_record``.

    Ratings may be numbers or text: they are read as text and parsed.
    """
    raw = (
        spark.read.schema(schemas.REVIEW)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )
    return raw.withColumn("overall", parse_rating(F.col("overall")))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.CURATED_CSV) -> DataFrame:
    """Headed CSV under an explicit schema: no inference pass over the data."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CURATED).parquet(path)


def write_curated(df: DataFrame, path: str) -> None:
    df.select(*schemas.CURATED.names).write.mode("overwrite").parquet(path)


def fill_missing_text(df: DataFrame, column: str = "lemmatized_text") -> DataFrame:
    return df.fillna({column: ""})


STORED = T.StructType([
    *schemas.PREDICTIONS.fields,
    T.StructField("stream", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("ingest_date", T.DateType()),
])


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Scored reviews of every batch, merged or not, with their stream, batch and day of storing."""
    return generations.read(spark, path, STORED)


def merge_predictions(spark: SparkSession, path: str, **options) -> generations.Generation:
    """Merge the folders of stored batches; rows keep their stream and batch."""
    return generations.merge(spark, path, STORED, partition_by=("ingest_date",), **options)


def read_batch(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Scored reviews of one folder below ``path``; no other folder is listed."""
    return spark.read.schema(STORED).option("basePath", path).parquet(folder)


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """Number of lines below a path, as a one-row table."""
    return spark.read.text(path).agg(F.count("*").alias("lines"))
