import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from review_pulse import schemas
from review_pulse.session import scratch_path, shared_dir
from review_pulse.sources import messages, tables

PAYLOADS = [
    '{"reviewText":"fine","overall":4.0,"reviewTime":"t","reviewerID":"r","asin":"a","review_id":"1"}',
    '{"overall":"5","asin":7}',
    "not json",
    '{"reviewText":"x","overall":"bad"}',
    '{"reviewText":"cut of',
    None,
]


def decoded(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(PAYLOADS)], "i int, value string")
    return messages.decode(df.repartition(1).sortWithinPartitions("i"))


def test_decoding_is_permissive(spark):
    rows = decoded(spark).collect()
    assert (rows[0].reviewText, rows[0].overall, rows[0].review_id) == ("fine", 4.0, "1")
    assert rows[1].asin == "7"
    assert rows[3].reviewText == "x" and rows[3].overall is None
    for i in (2, 4):
        assert rows[i][schemas.CORRUPT] == PAYLOADS[i]
        assert rows[i].reviewText is None and rows[i].asin is None
    assert rows[5][schemas.MISSING] and all(v is None for k, v in rows[5].asDict().items() if k != schemas.MISSING)


def test_quarantine_and_stats(spark):
    rows = decoded(spark)
    assert {r[schemas.CORRUPT] for r in messages.quarantined(rows).collect()} == {PAYLOADS[2], PAYLOADS[4]}
    assert messages.accepted(rows).count() == 3
    stats = messages.ingest_stats(rows).first().asDict()
    assert stats.pop("success_pct") == 50.0
    assert stats == {"total": 6, "sent": 3, "errors": 2, "wrong_typed": 2, "missing": 1}
    assert messages.ingest_stats(rows.limit(0)).first().success_pct == 0.0


def test_previews_fill_gaps(spark):
    rows = messages.message_previews(decoded(spark)).collect()
    assert (rows[0].reviewer_id, rows[0].asin, rows[0].rating, rows[0].preview) == ("r", "a", "4.0", "fine")
    assert (rows[2].reviewer_id, rows[2].asin, rows[2].rating, rows[2].preview) == ("N/A", "N/A", "N/A", "")


def test_json_lines_source(spark, tmp_path):
    path = tmp_path / "reviews.json"
    path.write_text("\n".join([json.dumps({"reviewText": "a\nb", "overall": 3, "extra": 1}), "{broken"]))
    rows = tables.read_reviews(spark, str(path)).collect()
    assert [r.reviewText for r in rows] == ["a\nb", None]
    assert [r[schemas.CORRUPT] for r in rows] == [None, "{broken"]
    assert tables.line_count(spark, str(path)).first().lines == 2
    with pytest.raises(AnalysisException):
        tables.read_reviews(spark, str(tmp_path / "missing"))


def test_csv_keeps_quotes_and_reads_empty_text_as_null(spark, tmp_path):
    rows = [("1", "r", "a", "t", 4.0, 'say "hi", ok', "", 2), ("2", None, "b", "t", None, "c", None, None)]
    df = spark.createDataFrame(rows, schemas.CURATED_CSV)
    tables.write_csv(df, str(tmp_path / "csv"))
    back = tables.fill_missing_text(tables.read_csv(spark, str(tmp_path / "csv"))).orderBy("review_id").collect()
    assert back[0].cleaned_text == 'say "hi", ok' and back[0].label == 2
    assert back[0].lemmatized_text == "" and back[1].lemmatized_text == ""
    assert back[1].reviewer_id is None and back[1].label is None


def test_publish_writes_one_line_per_review(spark, tmp_path):
    df = spark.createDataFrame(
        [("a\nb", 4.0, "t", "r", "p", "1"), (None, None, None, None, None, "2")],
        "review_text string, overall double, review_time string, reviewer_id string, asin string, review_id string",
    )
    messages.publish(df, path=str(tmp_path / "m"))
    assert tables.line_count(spark, str(tmp_path / "m")).first().lines == 2
    back = messages.decode(spark.read.text(str(tmp_path / "m")))
    assert {(r.review_id, r.reviewText) for r in back.collect()} == {("1", "a\nb"), ("2", None)}


def test_scratch_follows_the_configured_folder(spark):
    base = shared_dir(spark)
    assert shared_dir(spark) == base
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base) and first != second
