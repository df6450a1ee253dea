import json

from pyspark.sql import functions as F

from review_pulse import __main__ as cli
from review_pulse import schemas
from review_pulse.plans import jobs
from review_pulse.sources import messages, tables
from review_pulse.streaming import refresh, scoring

RATED = {1.0: "Terrible, broken!", 3.0: "An average thing...", 5.0: "I LOVE it; great"}


def raw_lines(n):
    for i in range(n):
        stars = list(RATED)[i % 3]
        yield {"reviewText": f"{RATED[stars]} {i}", "overall": stars, "reviewTime": "01 1, 2024",
               "reviewerID": f"r{i % 5}", "asin": f"p{i % 4}"}
    yield {"reviewText": "no rating", "overall": None, "reviewerID": "r0", "asin": "p0"}
    yield {"reviewText": None, "overall": 5.0, "reviewerID": "r0", "asin": "p0"}


def test_from_raw_reviews_to_the_dashboard(spark, tmp_path, capsys):
    at = {n: str(tmp_path / n) for n in (
        "curated", "csv", "models", "export", "messages", "predictions", "marts", "checkpoint")}
    source = tmp_path / "reviews.json"
    source.write_text("\n".join(json.dumps(r) for r in raw_lines(120)))

    jobs.run_curate(spark, str(source), at["curated"], at["csv"])
    curated = tables.read_curated(spark, at["curated"])
    assert curated.schema == schemas.CURATED
    assert curated.count() == 121  # the unrated review is dropped
    assert curated.select("review_id").distinct().count() == 121
    assert curated.where("cleaned_text = 'no text available'").count() == 1
    assert tables.read_csv(spark, at["csv"]).count() == 121

    jobs.run_train(spark, at["curated"], f"{at['models']}/first", "logistic", test_export=at["export"])
    exported = spark.read.json(f"{at['export']}/json")
    assert {"reviewText", "asin", "reviewTime", "reviewerID", "overall", "label"} <= set(exported.columns)

    messages.publish(curated, path=at["messages"])
    query = jobs.run_score(
        spark, at["models"], at["predictions"], at["marts"], at["checkpoint"],
        model_name="gone", lemmatize=True, trigger={"availableNow": True}, path=at["messages"],
    )
    scoring.await_all([query])
    stored = tables.read_predictions(spark, at["predictions"])
    assert stored.count() == 121
    agree = stored.join(curated.select("review_id", "label"), "review_id")
    assert agree.where(F.col("label") == F.col("predicted_label")).count() > 100

    panels = jobs.dashboard(stored, asin="p1")
    assert sum(r.reviews for r in panels["sentiment_counts"].collect()) == 121
    assert panels["sentiment_trend"].count() == 8
    assert panels["recent_reviews"].count() == 10
    assert panels["top_products"].count() == 4
    assert panels["product_sentiment"].first().total == 30

    kept = refresh.panels(spark, stored, at["marts"], asin="p1")
    assert set(kept) == set(panels)
    for name, panel in panels.items():
        assert list(map(tuple, kept[name].collect())) == list(map(tuple, panel.collect())), name


def test_texts_are_whole(spark):
    long = " ".join(["word"] * 30_000)
    raw = spark.createDataFrame([(long, "5", None, "r", "a", "1", None)], schemas.REVIEW)
    assert len(jobs.curate(raw).first().lemmatized_text) == len(long)


def test_ratings_given_as_text(spark, tmp_path):
    ratings = ['"5"', "5", '"2.9"', '"abc"', "null"]
    lines = [f'{{"reviewText":"t{i}","overall":{r}}}' for i, r in enumerate(ratings)]
    (tmp_path / "raw.json").write_text("\n".join(lines))
    got = jobs.curate(tables.read_reviews(spark, str(tmp_path / "raw.json"))).select("review_text", "overall", "label")
    assert sorted(map(tuple, got.collect())) == [("t0", 5.0, 2), ("t1", 5.0, 2), ("t2", 2.9, 0)]


def test_different_reviews_have_different_ids(spark):
    rows = [("same", "5", None, "r", None, None, None), ("same", "1", None, "r", None, None, None),
            ("same", "5", "r", None, None, None, None)]
    assert jobs.curate(spark.createDataFrame(rows, schemas.REVIEW)).select("review_id").distinct().count() == 3


def test_command_line_covers_every_job():
    parser = cli.build_parser()
    for line in ("curate in out --csv c", "train in m --family forest --order legacy", "publish in --option path=x",
                 "score m p marts c --available-now --lemmatize --option path=x", "dashboard p --marts m --days 3 --asin a"):
        assert parser.parse_args(line.split()).job == line.split()[0]


def test_merge_and_trend_jobs_follow_a_scored_stream(spark, tmp_path, capsys):
    at = {n: str(tmp_path / n) for n in ("messages", "predictions", "marts", "checkpoint", "trend", "trend_checkpoint")}
    for part in range(4):
        lines = [json.dumps({"reviewText": "x", "overall": 5.0, "review_id": f"{part}-{i}", "reviewerID": "r", "asin": "p"}) for i in range(5)]
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(at["messages"])
    scoring.await_all([scoring.score_stream(
        messages.read_stream(spark, path=at["messages"], maxFilesPerTrigger="1"),
        lambda rows: rows.withColumn("predicted_label", F.lit(2)), at["predictions"], at["checkpoint"],
        after_batch=refresh.refresh(at["predictions"], at["marts"]), trigger={"availableNow": True})])
    jobs.run_trend(spark, at["predictions"], at["trend"], at["trend_checkpoint"], trigger={"availableNow": True})
    assert "20" in capsys.readouterr().out
    jobs.run_merge(spark, at["predictions"], at["marts"], everything=True, vacuum=True)
    printed = capsys.readouterr().out
    assert "predictions: generation 1, 3 batches in 1 folders" in printed and "recent: generation 1" in printed
    assert tables.read_predictions(spark, at["predictions"]).count() == 20
    counts = refresh.sentiment_counts(spark, at["marts"]).collect()
    assert {r["label"]: r["reviews"] for r in counts} == {0: 0, 1: 0, 2: 20}


def test_every_job_has_arguments():
    parser = cli.build_parser()
    assert parser.parse_args(["preview", "c", "--option", "path=m", "--available-now"]).available_now
    assert parser.parse_args(["trend", "p", "t", "c", "--merge-every", "5"]).merge_every == 5
    assert parser.parse_args(["merge", "p", "m", "--vacuum"]).vacuum
