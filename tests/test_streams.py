import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from review_pulse import schemas
from review_pulse.operators import marts
from review_pulse.sources import messages, tables
from review_pulse.streaming import generations, late, refresh, scoring, trend

ONE_PASS = {"availableNow": True}


def by_length(rows):
    """A stand-in for a model: longer texts are better."""
    return rows.withColumn("predicted_label", F.least(F.length("lemmatized_text") % 4, F.lit(2)).cast("int"))


def reviews(spark, start, stop):
    ids = spark.range(start, stop)
    return ids.select(
        F.concat(F.lit("Text "), F.repeat(F.lit("x"), (F.col("id") % 5).cast("int"))).alias("review_text"),
        (F.col("id") % 5 + 1).cast("double").alias("overall"),
        F.lit("2024").alias("review_time"),
        F.concat(F.lit("r"), F.col("id") % 3).alias("reviewer_id"),
        F.concat(F.lit("p"), F.col("id") % 4).alias("asin"),
        F.col("id").cast("string").alias("review_id"),
    )


@pytest.fixture()
def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("messages", "predictions", "marts", "checkpoint", "quarantine")}


def run(spark, paths, **options):
    figures = []
    stream = messages.read_stream(spark, path=paths["messages"], maxFilesPerTrigger="1")
    query = scoring.score_stream(
        stream, by_length, paths["predictions"], paths["checkpoint"], quarantine=paths["quarantine"],
        after_batch=refresh.refresh(paths["predictions"], paths["marts"]), trigger=ONE_PASS,
        report=lambda _, counts: figures.append(counts), **options,
    )
    scoring.await_all([query])
    return figures


def test_stream_equals_batch_and_restarts_cleanly(spark, paths):
    messages.publish(reviews(spark, 0, 40).repartition(3), path=paths["messages"])
    spark.createDataFrame([('{"reviewText":"cut',)], "value string").write.mode("append").text(paths["messages"])
    figures = run(spark, paths)
    assert len(figures) > 1
    assert [sum(f[k] for f in figures) for k in ("total", "sent", "errors")] == [41, 40, 1]
    stored = tables.read_predictions(spark, paths["predictions"])
    assert stored.count() == 41
    assert stored.select("batch_id").distinct().count() > 1
    assert set(schemas.PREDICTIONS.names) <= set(stored.columns)

    batch = by_length(scoring.preprocess(messages.decode(spark.read.text(paths["messages"]))))
    pairs = lambda df: sorted(map(tuple, df.select("review_id", "predicted_label").collect()), key=str)
    assert pairs(stored) == pairs(batch)
    refused = spark.read.parquet(paths["quarantine"])
    assert [r.value for r in refused.collect()] == ['{"reviewText":"cut']

    assert run(spark, paths) == []  # nothing new
    assert tables.read_predictions(spark, paths["predictions"]).count() == 41
    messages.publish(reviews(spark, 40, 50).coalesce(1), path=paths["messages"])
    run(spark, paths)
    assert tables.read_predictions(spark, paths["predictions"]).count() == 51


def test_marts_equal_the_batch_queries(spark, paths):
    messages.publish(reviews(spark, 0, 60).repartition(4), path=paths["messages"])
    run(spark, paths)
    stored = tables.read_predictions(spark, paths["predictions"])
    mart = paths["marts"]
    as_of = marts.latest_moment(stored)

    def same(left, right):
        return list(map(tuple, left.collect())) == list(map(tuple, right.select(*left.columns).collect()))

    assert same(refresh.sentiment_counts(spark, mart), marts.sentiment_counts(stored))
    assert same(refresh.top_reviewers(spark, mart), marts.top_reviewers(stored))
    assert same(refresh.top_products(spark, mart), marts.top_products(stored))
    assert same(refresh.product_sentiment(spark, mart, "p1"), marts.product_sentiment(stored, "p1"))
    assert same(refresh.product_sentiment(spark, mart, "none"), marts.product_sentiment(stored, "none"))
    assert same(refresh.store_stats(spark, mart), marts.store_stats(stored))
    assert same(refresh.recent_reviews(spark, mart), marts.recent_reviews(stored, 15))
    assert same(refresh.sentiment_trend(spark, stored, mart, as_of), marts.sentiment_trend(stored, as_of))
    with pytest.raises(ValueError):
        refresh.recent_reviews(spark, mart, 16)


def test_mart_trend_cuts_both_end_days(spark, tmp_path):
    rows = [(str(i), "r", "p", 2, dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * i), "") for i in range(30)]
    stored = spark.createDataFrame(
        rows, "review_id string, reviewer_id string, asin string, predicted_label int,"
        " ingestion_time timestamp, lemmatized_text string",
    )
    refresh.refresh_from(stored, "s", 0, str(tmp_path))
    for as_of in (dt.datetime(2024, 1, 5, 7), dt.datetime(2024, 1, 3, 0), dt.datetime(2024, 1, 9)):
        quick = refresh.sentiment_trend(spark, stored, str(tmp_path), as_of, 3)
        full = marts.sentiment_trend(stored, as_of, 3)
        assert list(map(tuple, quick.collect())) == list(map(tuple, full.collect()))


def test_replayed_batch_replaces_itself(spark, paths):
    batch = messages.encode(reviews(spark, 0, 5))
    rows = scoring.to_predictions(by_length(scoring.preprocess(messages.decode(batch))))
    for _ in range(2):
        scoring.write_batch(rows, "s", 7, paths["predictions"])
        stored = tables.read_predictions(spark, paths["predictions"])
        refresh.refresh_from(stored, "s", 7, paths["marts"])
    assert stored.count() == 5
    assert refresh.store_stats(spark, paths["marts"]).first().total_predictions == 5


def test_two_checkpoints_into_one_target_keep_all_rows(spark, paths):
    messages.encode(reviews(spark, 0, 5)).select("value").write.mode("append").text(paths["messages"])
    for checkpoint in ("a", "b"):
        scoring.await_all([scoring.score_stream(
            messages.read_stream(spark, "text", path=paths["messages"]), by_length, paths["predictions"],
            paths["checkpoint"] + checkpoint, trigger=ONE_PASS,
            after_batch=refresh.refresh(paths["predictions"], paths["marts"]))])
    stored = tables.read_predictions(spark, paths["predictions"])
    assert stored.count() == 10 and stored.select("stream").distinct().count() == 2
    assert refresh.store_stats(spark, paths["marts"]).first().total_predictions == 10


def test_wide_recent_panel_is_whole(spark, paths):
    rows = scoring.to_predictions(by_length(scoring.preprocess(messages.decode(messages.encode(reviews(spark, 0, 40))))))
    scoring.write_batch(rows, "s", 0, paths["predictions"])
    stored = tables.read_predictions(spark, paths["predictions"])
    refresh.refresh_from(stored, "s", 0, paths["marts"])
    wide = refresh.panels(spark, stored, paths["marts"], limit=30)["recent_reviews"]
    assert sorted(map(str, wide.collect())) == sorted(map(str, marts.recent_reviews(stored, 30).collect()))
    assert wide.count() == 30


TIMED = "predicted_label int, ingestion_time timestamp"


def test_trend_stream_counts_days_and_drops_late_rows(spark, paths):
    def arrive(*rows):
        spark.createDataFrame(rows, TIMED).coalesce(1).write.mode("append").parquet(paths["messages"])

    def step():
        stream = spark.readStream.schema(TIMED).parquet(paths["messages"])
        query = trend.start(stream, paths["predictions"], paths["checkpoint"], lateness="1 day", trigger=ONE_PASS)
        scoring.await_all([query])

    arrive((2, dt.datetime(2024, 1, 1, 5)), (0, dt.datetime(2024, 1, 1, 6)), (None, dt.datetime(2024, 1, 1, 7)))
    step()
    arrive((1, dt.datetime(2024, 1, 2, 5)), (2, dt.datetime(2024, 1, 1, 23)))
    step()
    arrive((2, dt.datetime(2024, 1, 10)))
    step()
    arrive((2, dt.datetime(2024, 1, 1, 9)))  # far behind the watermark
    step()
    got = {str(r.day): (r.negative, r.neutral, r.positive) for r in trend.current(spark, paths["predictions"]).collect()}
    assert got == {"2024-01-01": (1, 0, 2), "2024-01-02": (0, 1, 0), "2024-01-10": (0, 0, 1)}


def test_one_failing_query_is_reported(spark, paths, tmp_path):
    messages.publish(reviews(spark, 0, 3), path=paths["messages"])
    stream = messages.read_stream(spark, path=paths["messages"])

    def broken(rows):
        raise ValueError("no model")

    bad = scoring.score_stream(stream, broken, paths["predictions"], paths["checkpoint"])
    good = scoring.score_stream(stream, by_length, str(tmp_path / "p2"), str(tmp_path / "c2"))
    with pytest.raises(StreamingQueryException):
        scoring.await_all([bad, good])
    assert not bad.isActive and not good.isActive


def test_console_preview_runs(spark, paths, capfd):
    messages.publish(reviews(spark, 0, 2), path=paths["messages"])
    stream = messages.read_stream(spark, path=paths["messages"])
    scoring.await_all([scoring.console_preview(stream, paths["checkpoint"], trigger=ONE_PASS)])


EVENTS = "review_id string, ingestion_time timestamp, predicted_label int"


def test_late_rows_correct_their_day_until_the_horizon(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "target", "checkpoint"))
    at = lambda day, hour=12: dt.datetime(2024, 1, day, hour)
    waves = [
        [(f"a{i}", at(1 + i % 10), i % 3) for i in range(30)],
        [("late 2", at(2), 0), ("edge", at(9, 12), 0), ("none", at(20), None), ("on time", at(9, 13), 1), ("far", at(25), 2)],
        [("dropped", at(2), 0), ("late 10", at(10), 0), ("last", at(26), 1)],
    ]
    for rows in waves:
        spark.createDataFrame(rows, EVENTS).coalesce(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENTS).parquet(source)
        scoring.await_all([late.start(
            stream, target, checkpoint, dt.timedelta(days=1), dt.timedelta(days=16), salts=3, trigger=ONE_PASS, fan=2)])
    found = {r["review_id"]: r["batch_id"] for r in late.late_rows(spark, target).collect()}
    assert set(found) == {"late 2", "late 10"} and found["late 2"] < found["late 10"]
    days = {r["day"].day: r for r in late.trend(spark, target).collect()}
    counts = {day: r["negative"] + r["neutral"] + r["positive"] for day, r in days.items()}
    assert counts == {1: 3, 2: 4, 3: 3, 4: 3, 5: 3, 6: 3, 7: 3, 8: 3, 9: 5, 10: 4, 25: 1, 26: 1}
    assert {day for day, r in days.items() if r["late"]} == {2, 10} and not days[26]["closed"] and days[10]["closed"]
    assert generations.current(spark, f"{target}/versions").folders  # versions were merged on the way


def test_trend_versions_are_merged(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "target", "checkpoint"))
    for k in range(4):
        rows = [(f"{k}-{i}", dt.datetime(2024, 1, 1 + i, k), 2) for i in range(3)]
        spark.createDataFrame(rows, EVENTS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENTS).parquet(source)
        scoring.await_all([trend.start(stream, target, checkpoint, lateness="5 days", trigger=ONE_PASS, fan=2)])
    assert {r["day"].day: r["positive"] for r in trend.current(spark, target).collect()} == {1: 4, 2: 4, 3: 4}
    folder = generations.current(spark, target).folders[0]
    assert spark.read.parquet(f"{target}/{generations.MERGED}/{folder.name}").count() == 3
