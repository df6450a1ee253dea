import pytest
from pyspark.sql import functions as F

from review_pulse.operators import models
from review_pulse.session import shared_dir
from review_pulse.streaming.files import Files

WORDS = {0: "awful broken refund waste", 1: "okay average fair medium", 2: "great love perfect excellent"}


def reviews(spark, sizes=(20, 12, 60)):
    rows = [
        (f"{label}-{i}", f"{WORDS[label]} item{i % 7}", label)
        for label, n in enumerate(sizes) for i in range(n)
    ]
    return spark.createDataFrame(rows, "review_id string, lemmatized_text string, label int")


def agreement(scored):
    return scored.agg(F.avg((F.col("label") == F.col("predicted_label")).cast("int"))).first()[0]


@pytest.mark.parametrize("family, overrides, least", [
    ("svm", {"maxIter": 8}, 0.9), ("logistic", {"regParam": 0.01}, 0.9), ("forest", {"numTrees": 10}, 0.7),
])
def test_prediction_is_the_class_code(spark, family, overrides, least):
    rows = models.prepare(reviews(spark))
    model = models.fit(rows, family, **overrides)
    assert agreement(models.score(model, rows)) > least
    unlabelled = models.score(model, rows.drop("label"))
    assert {r[0] for r in unlabelled.select("predicted_label").distinct().collect()} <= {0, 1, 2}


def test_class_codes_survive_a_missing_class(spark):
    rows = models.prepare(reviews(spark, sizes=(0, 15, 40)))
    model = models.fit(rows, "svm", maxIter=8)
    scored = models.score(model, rows.drop("label"))
    assert {r[0] for r in scored.select("predicted_label").distinct().collect()} == {1, 2}


def test_unknown_family_is_refused():
    with pytest.raises(ValueError):
        models.stages("tree")


@pytest.mark.parametrize("order", ["split_first", "legacy"])
def test_training_splits(spark, order):
    train, held_out = models.training_splits(reviews(spark, (60, 40, 300)), order=order)
    rows = train.unionByName(held_out)
    assert train.where("split <> 'train'").count() == held_out.where("split = 'train'").count() == 0
    ids = {name: {r[0] for r in rows.where(F.col("split") == name).select("review_id").collect()}
           for name in ("train", "validation", "test")}
    assert all(ids.values())
    if order == "split_first":
        assert not ids["train"] & (ids["validation"] | ids["test"])
        assert rows.where((F.col("split") != "train") & (F.col("copy") > 1)).count() == 0


def test_logistic_training_keeps_the_natural_mix(spark):
    rows = reviews(spark, (60, 40, 300))
    train, held_out = models.training_splits(rows, rebalance=models.wants_rebalancing("logistic"))
    assert train.count() + held_out.count() == 400 and train.select("review_id").distinct().count() == train.count()


def test_save_resolve_and_evaluate(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        models.resolve(spark, base)
    model, result = models.train_and_evaluate(reviews(spark, (60, 60, 80)), "logistic", regParam=0.01)
    assert {r.split for r in result.overall.collect()} == {"validation", "test"}
    models.save(model, f"{base}/b_model")
    models.save(model, f"{base}/a_model")
    models.save(model, f"{base}/a_model")
    assert models.stored_models(spark, base) == ["a_model", "b_model"]
    assert models.resolve(spark, base)[0] == "a_model"
    assert models.resolve(spark, base, "b_model")[0] == "b_model"
    name, loaded = models.resolve(spark, base, "absent")
    assert name == "a_model"
    rows = models.prepare(reviews(spark))
    pairs = lambda m: sorted(map(tuple, models.score(m, rows).select("review_id", "predicted_label").collect()))
    assert pairs(loaded) == pairs(model)


def test_grid_search_returns_a_usable_model(spark):
    rows = models.prepare(reviews(spark))
    model, scores = models.grid_search(rows, reg_params=(0.01, 10.0), folds=2)
    assert dict(scores)[0.01] > dict(scores)[10.0]
    assert agreement(models.score(model, rows)) > 0.9


def cached(spark):
    return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())


@pytest.mark.parametrize("family, small", [("svm", {"maxIter": 1}), ("forest", {"numTrees": 2}), ("logistic", {"maxIter": 1})])
def test_features_of_all_rows_are_not_kept_in_memory(spark, monkeypatch, family, small):
    kind = {"svm": models.LinearSVC, "forest": models.RandomForestClassifier, "logistic": models.LogisticRegression}[family]
    before, seen, fit = cached(spark), [], kind.fit

    def probed(self, rows, params=None):
        rows.count()  # whatever is marked for the cache is there by now
        seen.append(cached(spark) - before)
        return fit(self, rows, params)

    monkeypatch.setattr(kind, "fit", probed)
    models.fit(models.prepare(reviews(spark)), family, **small)
    assert seen == [set()] * (3 if family == "svm" else 1)


def test_kept_rows_go_when_they_have_been_read(spark):
    def held():
        return Files(spark, shared_dir(spark)).glob(f"{shared_dir(spark)}/features-*")

    before = held()
    models.fit(models.prepare(reviews(spark)), "forest", numTrees=2)
    with pytest.raises(RuntimeError), models._kept(reviews(spark)) as rows:
        assert rows.count() == 92 and len(held()) == len(before) + 1
        raise RuntimeError
    assert held() == before


def test_kept_rows_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(models, "scratch_path", lambda *_: (_ for _ in ()).throw(RuntimeError("no folder")))
    with models._kept(reviews(spark)) as rows:
        assert rows.count() == 92 and rows.storageLevel.useDisk and not rows.storageLevel.useMemory


def test_one_vs_rest_over_stored_rows_is_that_of_mllib(spark):
    rows = models.prepare(reviews(spark))
    *front, stored = models.stages("svm", maxIter=3)
    with models._encoded(rows.select("lemmatized_text", "label"), front) as (_, encoded):
        binary = models.LinearSVC(featuresCol="features", labelCol="indexed_label", **{**models.SVM_PARAMS, "maxIter": 3})
        plain = models.OneVsRest(classifier=binary, featuresCol="features", labelCol="indexed_label").fit(encoded)
        ours = stored.fit(encoded)
    assert len(ours.models) == len(plain.models) == 3
    for a, b in zip(ours.models, plain.models):
        assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), abs=1e-6)
        assert a.intercept == pytest.approx(b.intercept, abs=1e-6)
