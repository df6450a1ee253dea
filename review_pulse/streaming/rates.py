"""Rate of messages: sliding counts of what was read, accepted and refused, by the time of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from review_pulse.functions import display
from review_pulse.sources import messages
from review_pulse.streaming import generations
from review_pulse.streaming.scoring import batch_path, start_batches

ARRIVED = "arrived"
_COUNTS = ("total", "sent", "errors", "wrong_typed", "missing")
VERSIONS = T.StructType([
    T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType()),
    *[T.StructField(name, T.LongType()) for name in _COUNTS],
    T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType()),
])


def windowed(stream: DataFrame, width: str, slide: str, lateness: str) -> DataFrame:
    """Message counts per sliding window of ``value`` messages with a time of arrival.

    One state row per window: counts are added up before the exchange.
    """
    timed = stream.select("value", F.col(ARRIVED).cast("timestamp").alias(ARRIVED)).withWatermark(ARRIVED, lateness)
    decoded = messages.decode(timed, ARRIVED)
    counted = decoded.groupBy(F.window(ARRIVED, width, slide).alias("w")).agg(*messages.message_counts())
    return counted.select("w.start", "w.end", *_COUNTS)


def start(
    stream: DataFrame, path: str, checkpoint: str, width: str = "5 minutes", slide: str = "1 minute",
    lateness: str = "1 minute", trigger: dict | None = None, fan: int | None = None,
) -> StreamingQuery:
    """Store the windows that each micro-batch changed, in a folder per stream and batch."""

    def handle(changed: DataFrame, stream_id: str, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(batch_path(path, stream_id, batch_id))
        if fan:
            generations.merge(changed.sparkSession, path, VERSIONS, newest_versions, fan=fan)

    writer = windowed(stream, width, slide, lateness).writeStream.outputMode("update")
    return start_batches(writer.option("checkpointLocation", checkpoint), handle, trigger)


def newest_versions(versions: DataFrame) -> DataFrame:
    value = F.struct(*_COUNTS, "batch_id")
    newest = versions.groupBy("stream", "start", "end").agg(F.max_by(value, "batch_id").alias("v"))
    return newest.select("start", "end", "v.*", "stream")


def rates(spark: SparkSession, path: str) -> DataFrame:
    """Every window with its counts, accepted messages per minute, and the success share in percent."""
    newest = newest_versions(generations.read(spark, path, VERSIONS))
    sums = newest.groupBy("start", "end").agg(*[F.sum(name).alias(name) for name in _COUNTS])
    minutes = (F.unix_timestamp("end") - F.unix_timestamp("start")) / 60
    return sums.withColumns({
        "per_minute": F.col("sent") / minutes,
        "success_pct": display.percent(F.col("sent"), F.col("total")),
    })

