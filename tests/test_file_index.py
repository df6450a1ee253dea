"""Lookups of a few ids read the files that hold them."""

import pytest
from pyspark.sql import functions as F

from review_pulse.sources import file_index


@pytest.mark.parametrize("kind", ["long", "string"])
def test_only_the_files_of_the_ids_are_planned(spark, tmp_path, kind):
    path, side = str(tmp_path / "table"), str(tmp_path / "side")
    rows = spark.range(20_000).select(F.col("id").cast(kind).alias("id"), F.repeat(F.lit("x"), 50).alias("text"))
    rows.repartition(40, "id").write.parquet(path)  # every file spans the whole range: only the filters tell
    file_index.build(spark, path, "id", side)
    ids = [7, 1234, 19_999, 50_000] if kind == "long" else ["7", "1234", "19999", "none"]
    got = file_index.read_ids(spark, path, "id", side, ids)
    holding = {r["f"] for r in spark.read.parquet(path).where(F.col("id").isin(ids)).select(F.input_file_name().alias("f")).collect()}
    planned = set(got.inputFiles())
    assert holding <= planned and len(planned) <= len(holding) + 2
    assert sorted(str(r["id"]) for r in got.collect()) == sorted(map(str, ids[:3]))


def test_ranges_rule_files_out_and_new_files_are_read(spark, tmp_path):
    path, side = str(tmp_path / "table"), str(tmp_path / "side")
    spark.range(1000).repartitionByRange(8, "id").write.parquet(path)
    file_index.build(spark, path, "id", side)
    assert len(file_index.read_ids(spark, path, "id", side, [500]).inputFiles()) == 1
    assert file_index.read_ids(spark, path, "id", side, [5000]).count() == 0
    spark.range(5000, 5010).coalesce(1).write.mode("append").parquet(path)
    assert [r["id"] for r in file_index.read_ids(spark, path, "id", side, [5000]).collect()] == [5000]
    assert file_index.read_ids(spark, path, "id", side, []).count() == 0


def test_nulls_and_long_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(file_index, "MAX_BITS", 256)  # far too few bits: false alarms, no losses
    path, side = str(tmp_path / "table"), str(tmp_path / "side")
    spark.createDataFrame([(None,)] * 5, "id long").coalesce(1).write.parquet(path)
    spark.range(3000).repartition(6, "id").write.mode("append").parquet(path)
    file_index.build(spark, path, "id", side)
    assert file_index.read_ids(spark, path, "id", side, list(range(0, 3000, 100))).count() == 30
