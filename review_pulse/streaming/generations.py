"""Merged folders of a store that streams write batch by batch.

A store is a folder with one sub-folder per batch (``stream=.../batch_id=...``), which grows without end.
:func:`merge` writes the rows of many batches into one folder and then switches readers to it: the log has
one small file per generation that names every merged folder and the batches each one stands for, and a
generation counts from the moment its file is renamed into place. Readers take the newest generation
and, besides, the finished folders of batches that it does not cover. A batch that is replayed after it
was merged is covered, so its new folder is not read; a merge that fails leaves a folder that
nothing names. Two merges at once cannot both become the next generation.

Folders are merged in levels: ``fan`` folders of a level become one of the next, so a row is rewritten as
often as the logarithm of its store's batches. Old folders stay until :func:`vacuum`, so that readers
that began before a switch can finish.
"""

from __future__ import annotations

import functools
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_pulse.streaming.files import Files

LOG, MERGED = "_generations", "_merged"
FAN = 8
_BATCH = re.compile(r"/stream=([^/]+)/batch_id=(\d+)/_SUCCESS$")


@dataclass
class Folder:
    """A merged folder and the batches in it: of each stream, a list of numbers."""
    name: str
    level: int
    batches: dict[str, list[int]]


@dataclass
class Generation:
    number: int = 0
    folders: list[Folder] = field(default_factory=list)

    def covers(self, stream: str, batch_id: int) -> bool:
        return any(batch_id in f.batches.get(stream, ()) for f in self.folders)


def _log_files(files: Files, path: str) -> list[str]:
    return sorted(files.glob(f"{path}/{LOG}/*.json"))


def current(spark: SparkSession, path: str) -> Generation:
    """The newest generation; generation 0, of a store that was never merged, has no folders."""
    files = Files(spark, path)
    found = _log_files(files, path)
    return _parsed(files.read(found[-1])) if found else Generation()


def _parsed(content: str) -> Generation:
    entry = json.loads(content)
    return Generation(entry["number"], [Folder(**f) for f in entry["folders"]])


def finished_batches(spark: SparkSession, path: str) -> dict[tuple[str, int], str]:
    """Folder of every batch whose write has ended, by stream and number."""
    found = {}
    for marker in Files(spark, path).glob(f"{path}/stream=*/batch_id=*/_SUCCESS"):
        stream, batch_id = _BATCH.search(marker).groups()
        found[stream, int(batch_id)] = marker.rpartition("/")[0]
    return found


def _rows(spark: SparkSession, path: str, schema: T.StructType, merged: list[Folder], live: list[str],
          part: str | None = None) -> DataFrame:
    def named(rows: DataFrame, folder: Column) -> DataFrame:
        return rows.select(*schema.names, *([folder.alias(part)] if part else []))

    parts = [named(spark.read.schema(schema).parquet(f"{path}/{MERGED}/{f.name}"), F.lit(f.name)) for f in merged]
    if live:
        rows = spark.read.schema(schema).option("basePath", path).parquet(*sorted(live))
        parts.append(named(rows, F.concat_ws("/", "stream", "batch_id")))
    return functools.reduce(DataFrame.unionByName, parts or [named(spark.createDataFrame([], schema), F.lit(""))])


def read(spark: SparkSession, path: str, schema: T.StructType, part: str | None = None) -> DataFrame:
    """All rows of the store once, merged or not. ``schema`` may have columns that are folder names.

    ``part`` names a column for the folder that a row comes from.
    """
    generation = current(spark, path)
    live = [folder for key, folder in finished_batches(spark, path).items() if not generation.covers(*key)]
    return _rows(spark, path, schema, generation.folders, live, part)


def merge(spark: SparkSession, path: str, schema: T.StructType, combine: Callable[[DataFrame], DataFrame] | None = None,
          partition_by: tuple[str, ...] = (), fan: int = FAN, everything: bool = False) -> Generation:
    """Merge ``fan`` or more folders of a level into one of the next, for every level that has as many.

    The newest batch of each stream is left alone, as it may still be written again; a batch before it
    never is, but for a checkpoint that is set back, whose replays are covered. ``combine`` reduces
    the rows (sums of partial sums, say); its result must have the store's columns. With ``everything``, all
    settled batches and folders become one, however few they are.
    """
    generation = current(spark, path)
    batches = {key: folder for key, folder in finished_batches(spark, path).items() if not generation.covers(*key)}
    newest: dict[str, int] = {}
    for stream, batch_id in batches:
        newest[stream] = max(newest.get(stream, -1), batch_id)
    settled = {key: folder for key, folder in batches.items() if key[1] < newest[key[0]]}
    least = 1 if everything else fan
    chosen = settled if len(settled) >= least else {}
    folders, level = list(generation.folders), 0
    taken: list[Folder] = []
    while len(chosen) + len(taken) >= least:
        level += 1
        next_up = [f for f in folders if everything or f.level == level]
        if not next_up or not everything and len(next_up) + 1 < fan:
            break
        taken += next_up
        folders = [f for f in folders if f not in next_up]
    if len(chosen) + len(taken) < max(least, 1) or not chosen and len(taken) < 2:
        return generation
    rows = _rows(spark, path, schema, taken, list(chosen.values()))
    rows = (combine(rows) if combine else rows).hint("rebalance", *partition_by)
    name = uuid.uuid4().hex
    rows.select(*schema.names).write.partitionBy(*partition_by).parquet(f"{path}/{MERGED}/{name}")
    inside: dict[str, list[int]] = {}
    for stream, batch_id in [*chosen, *((s, b) for f in taken for s, ids in f.batches.items() for b in ids)]:
        inside.setdefault(stream, []).append(batch_id)
    merged = Folder(name, max([level, *(f.level for f in taken)]), {s: sorted(ids) for s, ids in inside.items()})
    following = Generation(generation.number + 1, [*folders, merged])
    files = Files(spark, path)
    if not files.create(f"{path}/{LOG}/{following.number:012d}.json", json.dumps(asdict(following))):
        files.delete(f"{path}/{MERGED}/{name}")  # another merge was first
        return current(spark, path)
    return following


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete what neither of the newest ``keep`` generations reads; gives the number of folders."""
    files = Files(spark, path)
    log = _log_files(files, path)
    kept = [_parsed(files.read(name)) for name in log[-keep:]]
    if not kept:
        return 0
    oldest = kept[0]
    stale = [folder for key, folder in finished_batches(spark, path).items() if oldest.covers(*key)]
    used = {f.name for generation in kept for f in generation.folders}
    earlier = [_parsed(files.read(name)) for name in log[:-keep]]
    stale += [f"{path}/{MERGED}/{f.name}" for generation in earlier for f in generation.folders if f.name not in used]
    for folder in dict.fromkeys(stale):
        files.delete(folder)
    for name in log[:-keep]:
        files.delete(name)
    return len(set(stale))


def sums(keys: list[str], values: list[str], largest: tuple[str, ...] = ()) -> Callable[[DataFrame], DataFrame]:
    """Partial results of many batches as one: values added up, or the largest taken, by key."""
    def combine(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(
            *[F.sum(v).cast("bigint").alias(v) for v in values], *[F.max(v).alias(v) for v in largest])

    return combine
