"""Decode, clean, score and store a stream of review messages."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from review_pulse import schemas
from review_pulse.functions import lexicon, text
from review_pulse.operators import models
from review_pulse.sources import messages

Scorer = Callable[[DataFrame], DataFrame]
Normaliser = Callable[[Column], Column]
AfterBatch = Callable[[SparkSession, str, int], None]
Report = Callable[[int, dict], None]


def lemmatized(review_text: Column) -> Column:
    """Full normalisation, as curated training rows have it."""
    return lexicon.lemmatize(text.with_placeholder(text.clean_batch(review_text)))


def message_id(decoded: DataFrame) -> Column:
    """The id a message brought along, else a digest: of its original if that is malformed, else of its fields.

    A message without a payload has none. So rows that tie on time are told apart as long as they differ.
    """
    names = [f.name for f in schemas.MESSAGE.fields if f.name in decoded.columns and f.name not in ("review_id", schemas.CORRUPT)]
    content = F.md5(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))
    if schemas.CORRUPT in decoded.columns:
        content = F.coalesce(F.md5(schemas.CORRUPT), F.when(~F.col(schemas.MISSING), content))
    return F.coalesce("review_id", content)


def preprocess(decoded: DataFrame, normalise: Normaliser = text.clean_stream) -> DataFrame:
    """An id for every message, normalised text under the name the model reads, and the dummy label.

    Cleaning alone is the default; pass :func:`lemmatized` to treat texts as in training.
    """
    return decoded.withColumns({
        "review_id": message_id(decoded),
        "lemmatized_text": normalise(F.col("reviewText")),
        "label": F.lit(0.0),
    })


def model_scorer(model: PipelineModel) -> Scorer:
    return lambda rows: models.score(model, rows)


def to_predictions(scored: DataFrame) -> DataFrame:
    """Stored columns, stamped with the time of the batch."""
    return scored.select(
        "review_id",
        F.col("reviewText").alias("text"),
        "lemmatized_text",
        "predicted_label",
        "asin",
        F.col("reviewTime").alias("review_time"),
        F.col("reviewerID").alias("reviewer_id"),
        F.current_timestamp().alias("ingestion_time"),
    )


def batch_path(path: str, stream: str, batch_id: int) -> str:
    """The folder of one batch of one stream: batch numbers start anew with every checkpoint."""
    return f"{path}/stream={stream}/batch_id={batch_id}"


def write_batch(predictions: DataFrame, stream: str, batch_id: int, path: str) -> None:
    """Replace the folder of this batch, so that a replayed batch leaves no second copy."""
    dated = predictions.withColumn("ingest_date", F.to_date("ingestion_time"))
    dated.write.mode("overwrite").partitionBy("ingest_date").parquet(batch_path(path, stream, batch_id))


def start_batches(writer, handle: Callable[[DataFrame, str, int], None], trigger: dict | None) -> StreamingQuery:
    """Start a query whose batches are handled together with the stream's id.

    Spark keeps that id in the checkpoint: it outlives restarts and differs between checkpoints.
    """
    running: list[StreamingQuery] = []
    started = threading.Event()

    def identified(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        handle(batch, str(running[0].id), batch_id)

    writer = writer.foreachBatch(identified)
    running.append((writer.trigger(**trigger) if trigger else writer).start())
    started.set()
    return running[0]


def land(
    stream: DataFrame,
    transform: Callable[..., DataFrame],
    path: str,
    checkpoint: str,
    after_batch: AfterBatch | None = None,
    side_output: Callable[[DataFrame, str, int], None] | None = None,
    trigger: dict | None = None,
    numbered: bool = False,
) -> StreamingQuery:
    """Turn each micro-batch into predictions and store it; empty batches are skipped.

    With ``numbered``, ``transform`` gets the stream's id and the batch number as well.

    The batch is kept while it is handled, so that its source is read once. ``side_output`` sees the raw
    batch; ``after_batch`` runs once the batch is stored.
    """

    def handle(batch: DataFrame, stream_id: str, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            rows = transform(batch, stream_id, batch_id) if numbered else transform(batch)
            write_batch(rows, stream_id, batch_id, path)
            if side_output:
                side_output(batch, stream_id, batch_id)
        finally:
            batch.unpersist()
        if after_batch:
            after_batch(batch.sparkSession, stream_id, batch_id)

    return start_batches(stream.writeStream.option("checkpointLocation", checkpoint), handle, trigger)


def score_stream(
    stream: DataFrame, scorer: Scorer, path: str, checkpoint: str, quarantine: str | None = None,
    normalise: Normaliser = text.clean_stream, report: Report | None = None,
    after_batch: AfterBatch | None = None, versioned: bool = False, **options,
) -> StreamingQuery:
    """Start the scoring query over a stream of ``value`` messages.

    A ``versioned`` scorer gets the stream's id and the batch number too, and so can change its model.

    Every message is scored, malformed ones as empty text; with ``quarantine`` the originals of
    the malformed ones are stored as well. One-vs-rest models cannot transform a streaming frame
    directly, so scoring happens per micro-batch. ``report`` receives the message counts of each
    batch, which are observed while it is written.
    """
    observed: dict[str, Observation] = {}

    def transform(batch: DataFrame, stream_id: str, batch_id: int) -> DataFrame:
        decoded = messages.decode(batch)
        if report:
            observed["batch"] = Observation()
            decoded = decoded.observe(observed["batch"], *messages.message_counts())
        rows = preprocess(decoded, normalise)
        return to_predictions(scorer(rows, stream_id, batch_id) if versioned else scorer(rows))

    def stored(spark: SparkSession, stream_id: str, batch_id: int) -> None:
        if report:
            report(batch_id, observed.pop("batch").get)
        if after_batch:
            after_batch(spark, stream_id, batch_id)

    def refuse(batch: DataFrame, stream_id: str, batch_id: int) -> None:
        refused = messages.quarantined(messages.decode(batch))
        refused.select(F.col(schemas.CORRUPT).alias("value")).write.mode("overwrite").parquet(
            batch_path(quarantine, stream_id, batch_id)
        )

    return land(
        stream, transform, path, checkpoint, after_batch=stored, numbered=True,
        side_output=refuse if quarantine else None, **options,
    )


def console_preview(stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Print decoded messages; for debugging only."""
    previews = messages.message_previews(messages.decode(stream))
    writer = (
        previews.writeStream.format("console")
        .outputMode("append")
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def await_all(queries: list[StreamingQuery], poll_seconds: int = 1) -> None:
    """Wait until every query has ended; the first failure is raised and stops the others."""
    running = list(queries)
    try:
        while running:
            # awaitTermination returns at once for an ended query and raises for a failed one.
            running = [q for q in running if not q.awaitTermination(poll_seconds)]
    finally:
        for query in queries:
            query.stop()
