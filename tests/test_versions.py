"""Models that change while a stream runs."""

import pytest

from review_pulse.operators import models
from review_pulse.plans.catalog import _length_model
from review_pulse.streaming import versions


def test_a_replayed_batch_keeps_its_version(spark, tmp_path):
    base, path = str(tmp_path / "models"), str(tmp_path / "predictions")
    for name, shift in (("a", 0), ("b", 1)):
        models.save(_length_model(shift), f"{base}/{name}")
    rows = spark.createDataFrame([("xxx",)], "lemmatized_text string")
    score = versions.scorer(base, path)
    label = lambda batch: score(rows, "s", batch).first()["predicted_label"]
    assert versions.in_use(spark, base) == "a" and label(0) == 0  # no log: the first by name
    assert versions.put_into_use(spark, base, "b") == 0
    assert (label(1), label(0)) == (1, 0)
    versions.put_into_use(spark, base, "a")
    assert [label(k) for k in (0, 1, 2)] == [0, 1, 0]
    fresh = versions.scorer(base, path)  # a restarted stream
    assert fresh(rows, "s", 1).first()["predicted_label"] == 1 and fresh(rows, "other", 1).first()["predicted_label"] == 0
    found = {(r["stream"], r["batch_id"]): r["model"] for r in versions.records(spark, path).collect()}
    assert found == {("s", 0): "a", ("s", 1): "b", ("s", 2): "a", ("other", 1): "a"}
    assert models.stored_models(spark, base) == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        versions.put_into_use(spark, base, "c")
    with pytest.raises(FileNotFoundError):
        versions.in_use(spark, str(tmp_path / "none"))
