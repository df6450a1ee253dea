"""Continuous sentiment trend: tumbling one-day windows with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from review_pulse.operators import marts
from review_pulse.streaming import generations
from review_pulse.streaming.scoring import batch_path, start_batches


def windowed_counts(stream: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Class counts per UTC day; rows later than ``lateness`` behind the newest are dropped.

    Grouping by day alone keeps one state row per day, and partial aggregation runs before the
    shuffle, so a busy day does not land in one task row by row.
    """
    timed = marts.with_prediction(stream).withColumn(
        marts.MOMENT, F.col(marts.MOMENT).cast("timestamp")
    ).withWatermark(marts.MOMENT, lateness)
    day = F.window(marts.MOMENT, "1 day").alias("w")
    return timed.groupBy(day).agg(*marts.class_tallies()).select(
        F.to_date("w.start").alias("day"), "negative", "neutral", "positive"
    )


VERSIONS = T.StructType([
    T.StructField("day", T.DateType()),
    *[T.StructField(name, T.LongType()) for name in ("negative", "neutral", "positive")],
    T.StructField("stream", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])


def start(
    stream: DataFrame, path: str, checkpoint: str, lateness: str = "1 day", trigger: dict | None = None,
    fan: int | None = None,
) -> StreamingQuery:
    """Store the days each micro-batch changed, in a folder per stream and batch.

    With ``fan``, folders are merged when there are as many; only the newest version of a day stays.
    """

    def handle(changed: DataFrame, stream_id: str, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(batch_path(path, stream_id, batch_id))
        if fan:
            merge(changed.sparkSession, path, fan=fan)

    writer = windowed_counts(stream, lateness).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return start_batches(writer, handle, trigger)


def newest_versions(versions: DataFrame) -> DataFrame:
    """The latest version of every day of each stream."""
    value = F.struct(*VERSIONS.names[1:4], "batch_id")
    return versions.groupBy("stream", "day").agg(F.max_by(value, "batch_id").alias("v")).select("day", "v.*", "stream")


def merge(spark: SparkSession, path: str, **options) -> generations.Generation:
    return generations.merge(spark, path, VERSIONS, newest_versions, **options)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The latest version of every day of each stream, summed over streams."""
    newest = newest_versions(generations.read(spark, path, VERSIONS))
    return newest.groupBy("day").agg(*[F.sum(n).alias(n) for n in VERSIONS.names[1:4]])
