import datetime as dt
import hashlib
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, StringIndexer
from pyspark.sql import functions as F

from review_pulse.operators import features, marts, metrics, profile, sampling, selection, threshold


def moment(day, hour=0, minute=0, second=0):
    return dt.datetime(2024, 1, day, hour, minute, second)


PREDICTION = (
    "review_id string, reviewer_id string, asin string, predicted_label int, "
    "ingestion_time {kind}, lemmatized_text string"
)


def predictions(spark, rows, kind="timestamp_ntz"):
    return spark.createDataFrame(rows, PREDICTION.format(kind=kind))


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_trend_bounds_and_empty_days(spark, kind):
    rows = [
        ("a", "r", "p", 2, moment(1, 12), ""),           # exactly on the lower end
        ("b", "r", "p", 2, moment(1, 11, 59, 59), ""),   # just before it
        ("c", "r", "p", 0, moment(4, 0), ""),
        ("d", "r", "p", None, moment(4, 1), ""),
        ("e", "r", "p", 1, moment(8, 12), ""),           # exactly on the upper end
        ("f", "r", "p", 1, moment(8, 12, 0, 1), ""),     # just after it
    ]
    trend = marts.sentiment_trend(predictions(spark, rows, kind), moment(8, 12)).collect()
    assert [r.day for r in trend] == [f"2024-01-0{d}" for d in range(1, 9)]
    assert [(r.negative, r.neutral, r.positive) for r in trend if r.negative + r.neutral + r.positive] == [
        (0, 0, 1), (1, 0, 0), (0, 1, 0)
    ]


def test_trend_pushes_time_filter_to_the_scan(spark, tmp_path):
    rows = [("a", "r", "p", 2, moment(d), "") for d in (1, 2, 3)]
    stored = predictions(spark, rows).withColumn("ingest_date", F.to_date("ingestion_time"))
    stored.write.partitionBy("ingest_date").parquet(str(tmp_path / "p"))
    trend = marts.sentiment_trend(spark.read.parquet(str(tmp_path / "p")), moment(3), days_back=1)
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "GreaterThanOrEqual(ingestion_time" in plan
    assert [r.positive for r in trend.collect()] == [1, 1]


def test_counts_cover_all_classes_and_ignore_stray_codes(spark):
    rows = [("a", "r", "p", 2, moment(1), ""), ("b", "r", "p", 7, moment(1), ""), ("c", "r", "p", None, moment(1), "")]
    got = marts.sentiment_counts(predictions(spark, rows)).collect()
    assert [tuple(r) for r in got] == [(0, "Negative", 0, 1), (1, "Neutral", 0, 1), (2, "Positive", 1, 1)]
    empty = predictions(spark, [])
    assert [r.reviews for r in marts.sentiment_counts(empty).collect()] == [0, 0, 0]
    assert [r.share_pct for r in marts.sentiment_share(empty).collect()] == [None] * 3


def test_top_reviewers_edges(spark):
    rows = [(str(i), who, "p", label, moment(1), "") for i, (who, label) in enumerate([
        ("single", 2), (None, 2), (None, 1), ("b", 0), ("b", 2), ("a", 2), ("a", 1), ("c", 2), ("c", 2), ("c", 2),
    ])]
    got = marts.top_reviewers(predictions(spark, rows)).collect()
    assert [(r.reviewer_id, r.total) for r in got] == [("c", 3), ("a", 2), ("b", 2)]
    assert (got[1].positive_pct, got[1].neutral_pct, got[1].negative_pct) == (50.0, 50.0, 0.0)
    assert [r.reviewer_id for r in marts.top_reviewers(predictions(spark, rows), 1).collect()] == ["c"]


def test_product_lookup_and_stats_on_nothing(spark):
    empty = predictions(spark, [])
    row = marts.product_sentiment(empty, "x").first()
    assert (row.asin, row.total, row.positive_pct) == ("x", 0, 0.0)
    stats = marts.store_stats(empty).first()
    assert (stats.total_predictions, stats.valid_predictions, stats.latest_prediction) == (0, 0, "None")
    assert marts.latest_prediction(empty).first().latest is None


def test_recent_reviews_order_text_and_missing_time(spark):
    rows = [
        ("1", "r", "p", 2, moment(1), "x" * 201), ("2", "r", "p", 0, moment(2), "short"),
        ("3", "r", "p", 9, moment(2), None), ("4", "r", "p", None, moment(9), "hidden"), ("5", "r", "p", 1, None, "t"),
    ]
    got = marts.recent_reviews(predictions(spark, rows)).collect()
    assert [r.review_id for r in got] == ["2", "3", "1", "5"]
    assert [r.sentiment for r in got] == ["Negative", "Unknown", "Positive", "Neutral"]
    assert got[3].ingestion_time == "Unknown" and len(got[2].lemmatized_text) == 203


def test_recent_reviews_reads_texts_from_the_newest_days_only(spark, tmp_path):
    rows = [(str(i), "r", "p", 2, moment(1 + i), f"text {i}") for i in range(20)]
    stored = predictions(spark, rows, "timestamp").withColumn("ingest_date", F.to_date("ingestion_time"))
    stored.write.partitionBy("ingest_date").parquet(str(tmp_path / "p"))
    recent = marts.recent_reviews(spark.read.parquet(str(tmp_path / "p")), 2)
    assert [r.lemmatized_text for r in recent.collect()] == ["text 19", "text 18"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert any(part.startswith("isnotnull(ingest_date") for part in plan.split("PartitionFilters: [")[1:])


def test_recent_reviews_looks_text_up(spark):
    rows = [(str(i), "r", "p", 2, moment(1 + i), None) for i in range(5)]
    texts = spark.createDataFrame([("4", "four"), ("0", "zero")], "review_id string, lemmatized_text string")
    got = marts.recent_reviews(predictions(spark, rows).drop("lemmatized_text"), 2, texts).collect()
    assert [(r.review_id, r.lemmatized_text) for r in got] == [("4", "four"), ("3", None)]


def test_rating_summary_ignores_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,), (float("nan"),)], "overall double")
    row = profile.rating_summary(df).first()
    assert (row.n, row.min, row.q25, row.q50, row.q75, row.max) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert row.std == pytest.approx(1.5275252)


def test_null_profile_counts_nan_on_floats_only(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "NaN")], "x double, s string")
    got = {r.column_name: r.n_missing for r in profile.null_profile(df).collect()}
    assert got == {"x": 2, "s": 1}


def labelled(spark, *sizes):
    rows = [(f"{label}-{i}", label) for label, n in enumerate(sizes) for i in range(n)]
    return spark.createDataFrame(rows, "id string, label int")


def counts(df):
    return {r.label: r["count"] for r in df.groupBy("label").count().collect()}


def test_exact_rebalance_matches_brute_force(spark):
    df = labelled(spark, 40, 7, 500)
    got = sampling.rebalance(df, "id", exact=True)
    assert counts(got) == {0: 40 * 3, 1: 7 * (120 // 7), 2: 120}
    digests = sorted((hashlib.md5(f"2-{i}:42".encode()).hexdigest(), f"2-{i}") for i in range(500))
    kept = {r.id for r in got.where("label = 2").collect()}
    assert kept == {i for _, i in digests[:120]}


def test_exact_rebalance_counts_copies_of_an_id(spark):
    rows = [("hot", 2)] * 300 + [(f"p{i}", 2) for i in range(100)] + [(f"n{i}", 0) for i in range(50)]
    df = spark.createDataFrame(rows, "id string, label int").repartition(5)
    got = sampling.rebalance(df, "id", exact=True)
    assert counts(got) == {0: 150, 2: 150}


def test_exact_rebalance_is_a_filter(spark):
    kept = sampling.rebalance(labelled(spark, 40, 7, 500), "id", exact=True)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_rebalance_edges(spark):
    # a negative class larger than a third of the positive one: nothing is thinned out
    assert counts(sampling.rebalance(labelled(spark, 50, 10, 60), "id", exact=True)) == {0: 50, 1: 60, 2: 60}
    # empty classes neither fail nor appear
    assert counts(sampling.rebalance(labelled(spark, 5, 0, 10), "id", exact=True)) == {0: 10, 2: 10}
    # without negative rows the positive class is left as it is
    assert counts(sampling.rebalance(labelled(spark, 0, 4, 10), "id", exact=True)) == {1: 8, 2: 10}
    assert counts(sampling.rebalance(labelled(spark, 0, 4, 10), "id")) == {1: 8, 2: 10}
    assert counts(sampling.rebalance(labelled(spark, 3, 2, 0), "id")) == {0: 3, 1: 2}


def test_hash_rebalance_is_close_and_stable(spark):
    df = labelled(spark, 300, 100, 3000)
    got = sampling.rebalance(df, "id")
    assert abs(counts(got)[2] - 900) < 90
    again = sampling.rebalance(df.repartition(7), "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


def test_many_copies_of_few_rows(spark):
    df = labelled(spark, 100, 3, 300)
    got = sampling.rebalance(df, "id", exact=True).select("id", "label", "copy")
    assert counts(got)[1] == 300 and got.distinct().count() == got.count()


def test_splits_partition_the_rows(spark):
    df = sampling.with_split(labelled(spark, 500, 500, 1000), "id")
    sizes = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 2000 and set(sizes) == {"train", "validation", "test"}
    assert 1500 < sizes["train"] < 1700
    parts = sampling.random_split(df)
    assert sum(p.count() for p in parts) == 2000
    assert sampling.shuffled(df, "id").count() == 2000


def test_weights_default_to_one_outside_the_classes(spark):
    df = spark.createDataFrame([("a", 0), ("b", 2), ("c", 2), ("d", 5)], "id string, label int")
    got = {r.id: r.weight for r in sampling.with_weights(df).collect()}
    assert got == {"a": 3.0, "b": 1.5, "c": 1.5, "d": 1.0}


def test_metrics_agree_with_mllib(spark):
    pairs = [(0.0, 0.0)] * 5 + [(0.0, 2.0)] * 3 + [(1.0, 2.0)] * 2 + [(2.0, 2.0)] * 7 + [(2.0, 0.0)]
    df = spark.createDataFrame(pairs, "label double, prediction double")
    confusion = metrics.confusion_matrix(df)
    classes = {r["class"]: r for r in metrics.per_class(confusion).collect()}
    total = metrics.overall(confusion).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name, column in [("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                         ("weightedRecall", "weighted_recall"), ("f1", "weighted_f1")]:
        assert total[column] == pytest.approx(ev.evaluate(df, {ev.metricName: name}))
    for label, row in classes.items():
        for name, column in [("precisionByLabel", "precision"), ("recallByLabel", "recall"), ("fMeasureByLabel", "f1")]:
            expected = ev.evaluate(df, {ev.metricName: name, ev.metricLabel: label})
            assert row[column] == pytest.approx(expected)
    assert classes[1.0].precision == 0.0  # never predicted


def test_metrics_leave_out_classes_that_never_occur(spark):
    df = spark.createDataFrame([(0, 1), (0, 0), (2, 2), (None, 1), (2, None)], "label int, prediction int")
    confusion = metrics.confusion_matrix(df)
    assert sorted(r["class"] for r in metrics.per_class(confusion).collect()) == [0.0, 2.0]
    shown = [tuple(r) for r in metrics.confusion_pivot(confusion, [0, 1, 2]).collect()]
    assert shown == [(0, 1, 1, 0), (2, 0, 0, 1)]


def test_metrics_per_split(spark):
    df = spark.createDataFrame([("v", 0, 0), ("t", 0, 1)], "split string, label int, prediction int")
    confusion = metrics.confusion_matrix(df, "split")
    got = {r.split: r.accuracy for r in metrics.overall(confusion, "split").collect()}
    assert got == {"v": 1.0, "t": 0.0}


def test_label_indexes_agree_with_mllib(spark):
    df = labelled(spark, 3, 2, 9).withColumn("label", F.col("label").cast("double"))
    for operator, order in [(features.label_index_frequency, "frequencyDesc"),
                            (features.label_index_alphabetical, "alphabetAsc")]:
        indexer = StringIndexer(inputCol="label", outputCol="i", stringOrderType=order).fit(df)
        mine = {r.label: r.indexed_label for r in operator(df).collect()}
        assert mine == {float(v): i for i, v in enumerate(indexer.labels)}


def test_idf_agrees_with_mllib(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a"]), (3, ["c", "b"]), (4, [])], "id int, w array<string>")
    mine = {r.term: r.idf for r in features.idf_terms(df, "w").collect()}
    vectorizer = CountVectorizer(inputCol="w", outputCol="v").fit(df)
    model = IDF(inputCol="v", outputCol="x").fit(vectorizer.transform(df))
    assert mine == pytest.approx(dict(zip(vectorizer.vocabulary, model.idf.toArray())))


def test_vocabulary_size_ties_and_unit_length(spark):
    df = spark.createDataFrame(
        [(1, ["bb", "aa", "aa", "x"]), (2, ["cc", "bb"]), (3, ["dd"]), (4, [""])], "id int, w array<string>"
    )
    counted = features.term_counts(df, "id", "w")
    terms = features.vocabulary(counted, 3).collect()
    assert [(r.term, r.total_tf, r.doc_freq) for r in terms] == [("aa", 2, 1), ("bb", 2, 2), ("cc", 1, 1)]
    scaled = features.vocab_tfidf(df, "id", "w", 3)
    norms = scaled.groupBy("id").agg(F.sum(F.col("tfidf") * F.col("tfidf")).alias("n")).collect()
    assert {r.id: pytest.approx(1.0) for r in norms} == {r.id: r.n for r in norms}
    assert {r.id for r in norms} == {1, 2}


def test_vocabulary_vectors_agree_with_the_relational_form(spark):
    df = spark.createDataFrame([(1, "bb aa aa"), (2, "cc bb x"), (3, "dd"), (4, "")], "id int, t string")
    model = features.fit_vocabulary(df, "t")
    terms = model.stages[1].vocabulary
    vectors = {
        (r.id, terms[i]): float(v)
        for r in model.transform(df).collect() for i, v in zip(r.features.indices, r.features.values)
    }
    split = df.select("id", F.split("t", " ").alias("w"))
    rows = {(r.id, r.term): r.tfidf for r in features.vocab_tfidf(split, "id", "w").collect()}
    assert vectors == pytest.approx(rows)


def test_rebalance_without_negatives_keeps_the_positive_rows(spark):
    rows = spark.createDataFrame([(str(i), 2 if i % 5 else 1) for i in range(100)], "review_id string, label int")
    for exact in (False, True):
        counts = sampling.rebalance(rows, "review_id", exact=exact).groupBy("label").count().collect()
        assert {r["label"]: r["count"] for r in counts} == {2: 80, 1: 80}


def test_hash_cut_refines_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BUCKET_DIGITS", 1)  # sixteen buckets: several rounds for 2,000 rows
    rows = spark.createDataFrame([(str(i % 1500),) for i in range(2000)], "review_id string")
    digests = sorted(hashlib.md5(f"{i % 1500}:7".encode()).hexdigest() for i in range(2000))
    for target in (1, 700, 1999, 2000):
        cut = sampling.hash_cut(rows, "review_id", target, 7)
        assert cut.digest == digests[target - 1]
        assert cut.rows == digests.count(cut.digest)
        assert cut.room == target - digests.index(cut.digest)
    assert sampling.hash_cut(rows, "review_id", 2001, 7) is None and sampling.hash_cut(rows, "review_id", 0, 7) is None


@pytest.mark.parametrize("shape", ["skewed", "uniform", "few", "ties", "none"])
def test_top_keys_by_threshold(spark, shape):
    draw = random.Random(1)
    key = {"skewed": lambda: int(draw.paretovariate(0.8)) % 2000, "uniform": lambda: draw.randrange(400),
           "few": lambda: draw.randrange(4), "ties": lambda: draw.randrange(60) // 2 * 2, "none": lambda: 0}[shape]
    rows = [(f"p{draw.randrange(8)}", f"u{key()}" if draw.random() > 0.02 else None, draw.randrange(3)) for _ in range(6000)]
    rows = rows if shape != "none" else []
    predictions = spark.createDataFrame(rows, "part string, reviewer_id string, predicted_label int").withColumn(
        "reviewer_id", F.col("reviewer_id"))
    partials = predictions.groupBy("part", "reviewer_id").agg(*marts.class_tallies(), F.count("*").alias("total"))
    got = threshold.top_keys(partials, "reviewer_id", "part").collect()
    assert list(map(tuple, got)) == list(map(tuple, marts.top_reviewers(predictions).collect()))
    used = threshold.rows_used(partials, "reviewer_id", "part").first()
    if shape == "skewed":  # the long tail is neither summed nor asked for again
        assert used["heavy_rows"] < 0.25 * used["rows"] and used["candidate_rows"] < 0.25 * used["rows"]
    assert max(used["heavy_rows"], used["candidate_rows"]) <= used["rows"]


@pytest.mark.parametrize("shape", ["distinct", "outliers", "one", "signs", "longs", "huge"])
def test_quantiles_of_any_column(spark, monkeypatch, shape):
    monkeypatch.setattr(selection, "BUCKETS", 16)  # many passes for 3,000 rows
    draw = random.Random(2)
    values = {
        "distinct": lambda: draw.random() * 1000, "outliers": lambda: draw.choice([draw.random(), 10.0 ** draw.randint(-300, 300)]),
        "one": lambda: 7.25, "signs": lambda: draw.choice([0.0, -0.0, draw.gauss(0, 1), -1e-320, 1e-320]),
        "longs": lambda: draw.randrange(-2**40, 2**40), "huge": lambda: draw.choice([-1.7e308, 1.7e308, draw.uniform(-1e308, 1e308)]),
    }[shape]
    rows = [values() for _ in range(3000)]
    kind = "long" if shape == "longs" else "double"
    table = spark.createDataFrame([(v,) for v in [*rows, None, *([] if kind == "long" else [float("nan")])]], f"v {kind}")
    ranks = [0, 1, 749, 1500, 2998, 2999, 3000]
    got = selection.order_statistics(table, "v", ranks)
    assert got == {r: sorted(rows)[r] for r in ranks[:-1]}
    if shape != "huge":
        want = [float(x) for x in np.quantile(np.array(rows, float), [0, 0.25, 0.5, 0.9, 1])]
        assert selection.quantiles(table, "v", [0, 0.25, 0.5, 0.9, 1]) == pytest.approx(want)
    assert selection.quantiles(table.where("v IS NULL"), "v", [0.5]) == [None]


def test_hashed_terms_have_the_buckets_of_the_hashing_stages(spark):
    draw = random.Random(3)
    words = lambda: ["".join(draw.choice("abcdé日𐐷") for _ in range(draw.randint(1, 9))) for _ in range(draw.randint(0, 30))]
    df = spark.createDataFrame([(i, words()) for i in range(40)], "id long, filtered_words array<string>")
    stages = [s for s in features.ngram_tfidf_stages(50) if not isinstance(s, IDF)]
    vectors = Pipeline(stages=stages).fit(df).transform(df).select("id", "tf").collect()
    want = {(r["id"], int(k)): int(v) for r in vectors for k, v in enumerate(r["tf"].toArray()) if v}
    got = {(r["id"], 50 * r["space"] + r["bucket"]): r["n"] for r in features.hashed_counts(df, "id", "filtered_words", 50).collect()}
    assert got == want
