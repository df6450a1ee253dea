"""Change of model in a running stream.

A log next to the models names the versions in the order they were put into use. Every batch takes the
newest one and records it, with the predictions, before anything is scored; a batch that is replayed finds its
record and is scored by the version it had, whatever has been put into use since.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from review_pulse.operators import models
from review_pulse.streaming.files import Files

LOG, RECORDS = "_versions", "_models"


def put_into_use(spark: SparkSession, base: str, name: str) -> int:
    """Make the model ``name`` below ``base`` the one that later batches take; gives the number of its entry."""
    if name not in models.stored_models(spark, base):
        raise FileNotFoundError(f"no model {name!r} below {base}")
    files = Files(spark, base)
    number = len(files.glob(f"{base}/{LOG}/*.json"))
    while not files.create(f"{base}/{LOG}/{number:012d}.json", json.dumps({"model": name})):
        number += 1  # somebody else put a version into use meanwhile
    return number


def in_use(spark: SparkSession, base: str) -> str:
    """The version put into use last; the first model by name where there is no log."""
    files = Files(spark, base)
    entries = sorted(files.glob(f"{base}/{LOG}/*.json"))
    if entries:
        return json.loads(files.read(entries[-1]))["model"]
    names = models.stored_models(spark, base)
    if not names:
        raise FileNotFoundError(f"no models below {base}")
    return names[0]


def record(spark: SparkSession, base: str, path: str, stream: str, batch_id: int) -> str:
    """The version of a batch of predictions below ``path``: the recorded one, else the one in use, recorded now."""
    files = Files(spark, path)
    name = f"{path}/{RECORDS}/{stream}-{batch_id:012d}.json"
    if not files.exists(name):
        entry = {"stream": stream, "batch_id": batch_id, "model": in_use(spark, base)}
        files.create(name, json.dumps(entry))
    return json.loads(files.read(name))["model"]


def records(spark: SparkSession, path: str) -> DataFrame:
    """Stream, batch and model of every recorded batch."""
    return spark.read.schema("stream string, batch_id long, model string").json(f"{path}/{RECORDS}/*.json")


def scorer(base: str, path: str):
    """For :func:`scoring.score_stream`: scores a batch by the version that is recorded for it."""
    loaded: dict[str, PipelineModel] = {}

    def score(rows: DataFrame, stream: str, batch_id: int) -> DataFrame:
        name = record(rows.sparkSession, base, path, stream, batch_id)
        if name not in loaded:
            loaded[name] = PipelineModel.load(f"{base.rstrip('/')}/{name}")
        return models.score(loaded[name], rows)

    return score
