"""Daily class counts that late rows correct.

Rows are kept in state by day and salt, so that a busy day is spread over ``salts`` keys. A row is late
when it is more than ``lateness`` behind the newest row of earlier batches. It still counts, for as long as
``horizon``: it goes to a side table, and its day gets a corrected version. A timer closes a day
when no row of it can be on time any more, and another one ends its state when not even a late row
is accepted; what comes after that is dropped by Spark and shows in the query's progress.

Spark's watermark is what rows are measured by. It is set ``lateness + horizon`` behind, as Spark drops
all rows below it; the bar for being on time is ``horizon`` above it.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues,
)

from review_pulse.functions.labels import CLASS_CODES
from review_pulse.operators import marts
from review_pulse.streaming import generations
from review_pulse.streaming.scoring import batch_path, start_batches

DAY = 24 * 3600 * 1000
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FOLDERS = [T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())]
_COUNTS = [T.StructField(n, T.LongType()) for n in ("negative", "neutral", "positive", "late")]
VERSIONS = T.StructType([T.StructField("day", T.DateType()), T.StructField("salt", T.IntegerType()), *_COUNTS,
                         T.StructField("closed", T.BooleanType()), *_FOLDERS])
LATE = T.StructType([T.StructField("review_id", T.StringType()), T.StructField(marts.PREDICTED, T.IntegerType()),
                     T.StructField(marts.MOMENT, T.TimestampType()), *_FOLDERS])
_OUT = T.StructType([*VERSIONS.fields[:-2], *LATE.fields[:-2]])


class DayCounts(StatefulProcessor):
    """Counts of one day and salt; emits a version when they change or the day closes, and late rows."""

    def __init__(self, horizon: int) -> None:
        self.horizon = horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", T.StructType([*_COUNTS, T.StructField("closed", T.BooleanType())]))

    def _version(self, key: tuple, counts: list) -> pd.DataFrame:
        values = [*key, *counts]
        return pd.DataFrame({f.name: [v] for f, v in zip(_OUT.fields, [*values, *[None] * (len(_OUT) - len(values))])})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        *counts, late, closed = self.counts.get() if self.counts.exists() else [0, 0, 0, 0, False]
        for some in rows:
            for k, code in enumerate(CLASS_CODES):
                counts[k] += int((some[marts.PREDICTED] == code).sum())
            behind = some[some[marts.MOMENT] < pd.Timestamp(watermark + self.horizon, unit="ms")]
            if watermark > 0 and len(behind):
                late += len(behind)
                yield pd.DataFrame({f.name: behind[f.name] if f.name in behind else None for f in _OUT.fields})
        self.counts.update((*counts, late, closed))
        end = int(pd.Timestamp(key[0]).value // 10**6) + DAY
        for moment in (end - self.horizon, end):
            if moment > watermark:
                self.handle.registerTimer(moment)
        yield self._version(key, [*counts, late, closed])

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = int(pd.Timestamp(key[0]).value // 10**6) + DAY
        *counts, late, closed = self.counts.get()
        if not closed:
            self.counts.update((*counts, late, True))
            yield self._version(key, [*counts, late, True])
        if expiredTimerInfo.getExpiryTimeInMs() >= end:
            self.counts.clear()

    def close(self) -> None:
        pass


def counted(stream: DataFrame, lateness: timedelta, horizon: timedelta, salts: int) -> DataFrame:
    """Versions of days and late rows of a stream of predictions."""
    behind = int((lateness + horizon).total_seconds())
    timed = marts.with_prediction(stream).withColumn(marts.MOMENT, F.col(marts.MOMENT).cast("timestamp"))
    timed = timed.withWatermark(marts.MOMENT, f"{behind} seconds").select(
        F.to_date(marts.MOMENT).alias("day"),
        F.pmod(F.xxhash64("review_id"), F.lit(salts)).cast("int").alias("salt"),
        "review_id", marts.PREDICTED, marts.MOMENT)
    return timed.groupBy("day", "salt").transformWithStateInPandas(
        DayCounts(int(horizon.total_seconds() * 1000)), _OUT, "Update", "EventTime")


def start(
    stream: DataFrame, path: str, checkpoint: str, lateness: timedelta = timedelta(days=1),
    horizon: timedelta = timedelta(days=30), salts: int = 32, trigger: dict | None = None, fan: int | None = None,
) -> StreamingQuery:
    """Store versions below ``path/versions`` and late rows below ``path/late``, a folder per batch.

    With ``fan``, folders are merged when there are as many; of the versions only the newest stay.
    """
    spark = stream.sparkSession

    def handle(changed: DataFrame, stream_id: str, batch_id: int) -> None:
        changed.persist()
        try:
            versions, late = changed.where("review_id IS NULL"), changed.where("review_id IS NOT NULL")
            for name, rows, schema in (("versions", versions, VERSIONS), ("late", late, LATE)):
                folder = batch_path(f"{path}/{name}", stream_id, batch_id)
                rows.select(*schema.names[:-2]).write.mode("overwrite").parquet(folder)
        finally:
            changed.unpersist()
        if fan:
            merge(changed.sparkSession, path, fan=fan)

    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)  # the query keeps the setting it is started with
    try:
        writer = counted(stream, lateness, horizon, salts).writeStream.outputMode("update")
        return start_batches(writer.option("checkpointLocation", checkpoint), handle, trigger)
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def newest_versions(versions: DataFrame) -> DataFrame:
    """The last version of every day and salt of each stream."""
    value = F.struct(*VERSIONS.names[2:-2], "batch_id")
    newest = versions.groupBy("stream", "day", "salt").agg(F.max_by(value, "batch_id").alias("v"))
    return newest.select("day", "salt", "v.*", "stream")


def merge(spark: SparkSession, path: str, **options) -> None:
    generations.merge(spark, f"{path}/versions", VERSIONS, newest_versions, **options)
    generations.merge(spark, f"{path}/late", LATE, **options)


def trend(spark: SparkSession, path: str) -> DataFrame:
    """Corrected class counts of every day, the late rows among them, and whether the day is closed."""
    newest = newest_versions(generations.read(spark, f"{path}/versions", VERSIONS))
    return newest.groupBy("day").agg(*[F.sum(f.name).alias(f.name) for f in _COUNTS], F.every("closed").alias("closed"))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    return generations.read(spark, f"{path}/late", LATE)
