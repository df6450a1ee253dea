"""Exact order statistics and quantiles of any numeric column, by histograms that are refined.

A pass counts the rows of every bucket of the ranges that hold a wanted rank, with the least and largest
value of each bucket; the bucket that a rank falls into is the range of the next pass. The first
buckets are binades (sign and power of two), so a few outliers cannot crowd all other values into one
bucket; later ones are equal parts of a range. A range of few rows is resolved value by value. No buffer
ever holds more than ``BUCKETS`` entries for a rank, however many distinct values there are, and a
range shrinks by that factor with every pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


@dataclass(frozen=True)
class Range:
    """Values from ``low`` to ``high``, how many rows lie below them and how many within."""
    low: object
    high: object
    before: int
    rows: int


def present(df: DataFrame, column: str) -> DataFrame:
    """The rows that have a value: neither NULL nor NaN."""
    known = F.col(column).isNotNull()
    return df.where(known & ~F.isnan(column)) if df.schema[column].dataType.simpleString() in ("float", "double") else df.where(known)


def _binade(value: Column) -> Column:
    number = value.cast("double")
    power = F.when(F.abs(number) == float("inf"), 2000).otherwise(F.floor(F.log2(F.abs(number))))
    return (F.signum(number) * F.coalesce(power + 2000, F.lit(0))).cast("long")


def _part(value: Column, within: Range) -> Column:
    """Halves keep the width of a range from overflowing; the result never falls as the value rises."""
    low, high = float(within.low), float(within.high)
    width = high / 2 - low / 2
    if not 0 < width < math.inf:
        return F.lit(0).cast("long")
    return F.floor((value.cast("double") / 2 - low / 2) / width * (BUCKETS - 1)).cast("long")


def _refined(df: DataFrame, column: str, ranges: list[Range]) -> dict[int, list[Range]]:
    """The buckets of every range in order: one pass, one row per bucket."""
    value = F.col(column)
    cases = [F.when(value.between(F.lit(r.low), F.lit(r.high)), F.struct(
        F.lit(k).alias("range"),
        (F.lit(None).cast("long") if r.rows <= BUCKETS else _part(value, r)).alias("bucket"),
        (value if r.rows <= BUCKETS else F.lit(None).cast(df.schema[column].dataType)).alias("single"))) for k, r in enumerate(ranges)]
    rows = df.select(value.alias("v"), F.coalesce(*cases).alias("at")).where("at IS NOT NULL")
    found = rows.groupBy("at.range", "at.bucket", "at.single").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))
    out: dict[int, list[Range]] = {}
    for r in sorted(found.collect(), key=lambda r: (r["range"], r["low"])):
        own = out.setdefault(r["range"], [])
        before = own[-1].before + own[-1].rows if own else ranges[r["range"]].before
        own.append(Range(r["low"], r["high"], before, r["n"]))
    return out


def order_statistics(df: DataFrame, column: str, ranks: list[int]) -> dict[int, object]:
    """The values at some ranks, counted from 0, of the sorted column. Ranks beyond the rows have none."""
    rows = present(df, column)
    first = rows.groupBy(_binade(F.col(column)).alias("bucket")).agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count("*").alias("n")).collect()
    buckets, before = [], 0
    for r in sorted(first, key=lambda r: r["bucket"]):
        buckets.append(Range(r["low"], r["high"], before, r["n"]))
        before += r["n"]
    wanted = {rank: _holding(buckets, rank) for rank in ranks if 0 <= rank < before}
    while open_ranges := sorted({r for r in wanted.values() if r.low != r.high}, key=lambda r: r.before):
        refined = _refined(rows, column, open_ranges)
        for rank, within in wanted.items():
            if within in open_ranges:
                wanted[rank] = _holding(refined[open_ranges.index(within)], rank)
    return {rank: within.low for rank, within in wanted.items()}


def _holding(buckets: list[Range], rank: int) -> Range:
    return next(b for b in buckets if b.before <= rank < b.before + b.rows)


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Interpolated quantiles: between the two values around ``share * (rows - 1)``. NULL without rows."""
    count = present(df, column).count()
    places = [share * (count - 1) for share in shares]
    ranks = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    values = order_statistics(df, column, ranks) if count else {}
    out: list[float | None] = []
    for p in places:
        if not count:
            out.append(None)
            continue
        low, high = float(values[math.floor(p)]), float(values[math.ceil(p)])
        out.append(low if low == high else low + (high - low) * (p - math.floor(p)))
    return out
