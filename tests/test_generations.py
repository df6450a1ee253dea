"""Merging the folders that streams write: same rows before, during and after, however merges and replays cross."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_pulse.streaming import generations
from review_pulse.streaming.scoring import batch_path

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()),
                       T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())])
SUMS = T.StructType(SCHEMA.fields[:2])


def put(spark, path, stream, batch_id, rows=5):
    ids = spark.range(100 * batch_id, 100 * batch_id + rows).withColumn("n", F.lit(1).cast("long"))
    ids.coalesce(1).write.mode("overwrite").parquet(batch_path(path, stream, batch_id))


def rows_of(spark, path):
    return sorted(tuple(r) for r in generations.read(spark, path, SCHEMA).collect())


def merged_folders(spark, path):
    return [(f.level, sum(map(len, f.batches.values()))) for f in generations.current(spark, path).folders]


def test_rows_stay_the_same_through_merge_replay_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "store")
    assert generations.read(spark, path, SCHEMA).count() == 0 and generations.merge(spark, path, SCHEMA).number == 0
    for k in range(4):
        put(spark, path, "a", k)
    put(spark, path, "b", 0)
    before = rows_of(spark, path)
    assert len(before) == 25
    early = generations.read(spark, path, SCHEMA)  # a reader that began before the switch
    assert generations.merge(spark, path, SCHEMA, fan=3).number == 1
    assert merged_folders(spark, path) == [(1, 3)]  # the newest batch of either stream is left alone
    assert rows_of(spark, path) == before == sorted(map(tuple, early.collect()))
    put(spark, path, "a", 1, rows=7)  # a replay of a merged batch, even with other rows, is covered
    assert rows_of(spark, path) == before
    assert generations.vacuum(spark, path, keep=1) == 3
    assert rows_of(spark, path) == before
    put(spark, path, "a", 1)  # and so is one after the old folders are gone
    assert rows_of(spark, path) == before


def test_levels_bound_how_often_a_row_is_rewritten(spark, tmp_path):
    path, written = str(tmp_path / "store"), 0
    for k in range(17):
        put(spark, path, "a", k, rows=1)
        number = generations.current(spark, path).number
        generation = generations.merge(spark, path, SCHEMA, fan=2)
        if generation.number > number:
            written += sum(len(b) for b in generation.folders[-1].batches.values())
        assert len(rows_of(spark, path)) == k + 1
    assert written <= 16 * 5
    assert len(generations.current(spark, path).folders) <= 5
    generations.merge(spark, path, SCHEMA, everything=True)
    assert merged_folders(spark, path)[0][1] == 16 and len(rows_of(spark, path)) == 17
    assert generations.vacuum(spark, path, keep=1) > 0 and len(rows_of(spark, path)) == 17


def test_partial_sums_are_merged_into_one(spark, tmp_path):
    path = str(tmp_path / "marts")
    for k in range(5):
        spark.createDataFrame([(1, 10), (k, 1)], "id long, n long").write.parquet(batch_path(path, "a", k))
    total = lambda: dict(generations.read(spark, path, SUMS).groupBy("id").agg(F.sum("n")).collect())
    before = total()
    generations.merge(spark, path, SUMS, generations.sums(["id"], ["n"]), fan=4)
    assert total() == before
    folder = generations.current(spark, path).folders[0]
    assert spark.read.parquet(f"{path}/{generations.MERGED}/{folder.name}").count() == 4


def test_a_failed_merge_and_a_lost_race_change_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    for k in range(4):
        put(spark, path, "a", k)
    before = rows_of(spark, path)
    with pytest.raises(Exception):
        generations.merge(spark, path, SCHEMA, lambda rows: rows.withColumn("n", F.raise_error(F.lit("lost")).cast("long")), fan=2)
    assert generations.current(spark, path).number == 0 and rows_of(spark, path) == before

    real = generations.Files.create

    def late(self, name, content):  # another merge becomes generation 1 meanwhile
        entry = json.loads(content)
        entry["folders"] = []
        assert real(self, name, json.dumps(entry))
        return real(self, name, content)

    monkeypatch.setattr(generations.Files, "create", late)
    assert generations.merge(spark, path, SCHEMA, fan=2).folders == []
    monkeypatch.undo()
    assert rows_of(spark, path) == before
    assert generations.merge(spark, path, SCHEMA, fan=2).number == 2 and rows_of(spark, path) == before


def test_unfinished_batches_are_not_read(spark, tmp_path):
    path = str(tmp_path / "store")
    put(spark, path, "a", 0)
    put(spark, path, "a", 1)
    (tmp_path / "store" / "stream=a" / "batch_id=1" / "_SUCCESS").unlink()
    assert {r[3] for r in rows_of(spark, path)} == {0}
