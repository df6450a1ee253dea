"""Which files of a table can hold a few given ids: key ranges and Bloom filters in a side table.

:func:`build` reads the key column alone and writes, for every file, its least and largest key and the
words of a Bloom filter that are not zero, one row per word, sorted by word. :func:`files_with` reads the
rows of the few words that the asked ids need and gives the files in which some id has all its bits and
lies in the range; :func:`read_ids` then plans a scan of those files only. A file that the filter names
wrongly is read in vain; none that holds an id is left out. Files added since are known by their
absence from the side table and are always read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HASHES = 4
BITS_PER_KEY = 16
MAX_BITS = 1 << 22  # of one file's filter; a longer file gets more false alarms, not a longer filter


def _places(key: Column, bits: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(k)), bits) for k in range(HASHES)])


def build(spark: SparkSession, path: str, key: str, target: str) -> None:
    """Write the side table of the Parquet table at ``path`` to ``target``."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col(key).alias("key"))
    ranges = rows.groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("key").alias("n"))
    most = ranges.agg(F.max("n").alias("n")).first()["n"] or 1
    bits = min(MAX_BITS, 1 << (BITS_PER_KEY * most - 1).bit_length())
    places = rows.where("key IS NOT NULL").select("file", F.explode(_places(F.col("key"), F.lit(bits))).alias("place"))
    words = places.select("file", F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, CAST(place % 64 AS INT))").alias("bit"))
    masks = words.groupBy("file", "word").agg(F.bit_or("bit").alias("mask"))
    side = masks.join(ranges, "file").select("file", "word", "mask", "low", "high", F.lit(bits).cast("long").alias("bits"))
    empty = ranges.where("n = 0").select(
        "file", F.lit(-1).cast("long").alias("word"), F.lit(0).cast("long").alias("mask"), "low", "high", F.lit(bits).cast("long").alias("bits"))
    side.unionByName(empty).sortWithinPartitions("word", "file").write.mode("overwrite").parquet(target)


def files_with(spark: SparkSession, target: str, ids: list) -> list[str]:
    """The indexed files that may hold one of some ids, a list short enough for a literal."""
    side = spark.read.parquet(target)
    first = side.select("bits").first()
    if first is None or not ids:
        return []
    kind = side.schema["low"].dataType
    asked = spark.createDataFrame([(str(i),) for i in set(ids)], "id string").select(F.col("id").cast(kind))
    needed = asked.select("id", F.posexplode(_places(F.col("id"), F.lit(first["bits"]))).alias("hash", "place")).select(
        "id", "hash", F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, CAST(place % 64 AS INT))").alias("bit"))
    wanted = [r["word"] for r in needed.select("word").distinct().collect()]
    hits = side.where(F.col("word").isin(wanted)).join(F.broadcast(needed), "word").where(
        (F.col("mask").bitwiseAND(F.col("bit")) != 0) & F.col("id").between(F.col("low"), F.col("high")))
    found = hits.groupBy("file", "id").agg(F.count_distinct("hash").alias("n")).where(F.col("n") == HASHES)
    return sorted(r["file"] for r in found.select("file").distinct().collect())


def read_ids(spark: SparkSession, path: str, key: str, target: str, ids: list) -> DataFrame:
    """The rows of some ids, from the files that may hold them and from files younger than the side table."""
    table = spark.read.parquet(path)
    known = {_same(r["file"]) for r in spark.read.parquet(target).select("file").distinct().collect()}
    chosen = files_with(spark, target, ids) + sorted(f for f in table.inputFiles() if _same(f) not in known)
    rows = spark.read.schema(table.schema).parquet(*chosen) if chosen else spark.createDataFrame([], table.schema)
    return rows.where(F.col(key).isin(list(ids)))


def _same(name: str) -> str:
    """One spelling of a file's name: a local one may have one slash or three after its scheme."""
    return re.sub(r"^([\w+.-]+):/+", r"\1:/", name)
