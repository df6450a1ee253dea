"""Exact top keys from partial counts, without summing every key: a threshold protocol in three phases.

Partials are per-part counts, such as those of stored batches; a key occurs at most once in a part.

1. The heads of all parts, ``limit`` rows each, are summed. The ``limit``-th best sum is a first bar that
   the true result must reach, and a key that reaches it has at least ``bar / parts`` in some part.
2. Only rows of at least that much are summed. What a key may have besides is bounded by that much less one
   in every part where it was not seen; the ``limit``-th best sum is a higher bar, and keys whose
   bound stays below it are out.
3. The rows of the keys that are left are summed exactly.

Each phase is a filter before the exchange, so keys of the long tail are neither shuffled nor kept; rows
of equal totals are settled by key in the last phase. Sums never come to the driver, but the two bars do.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_pulse.operators import marts


@dataclass(frozen=True)
class Plan:
    """What the first two phases found: rows of a part that count, and the keys that can qualify."""
    parts: int
    least: int
    candidates: DataFrame


def _bar(sums: DataFrame, value: str, limit: int) -> int:
    """The ``limit``-th largest value, 0 if there are fewer."""
    best = sums.orderBy(F.desc(value)).limit(limit).agg(F.min(value).alias("least"), F.count("*").alias("n")).first()
    return best["least"] if best["n"] == limit else 0


def plan(partials: DataFrame, key: str, part: str, limit: int = 10) -> Plan:
    rows = partials.where(F.col(key).isNotNull()).select(part, key, "total")
    parts = rows.select(F.count_distinct(part)).first()[0]
    rank = F.row_number().over(Window.partitionBy(part).orderBy(F.desc("total")))
    heads = rows.withColumn("rank", rank).where(F.col("rank") <= limit)
    first = _bar(heads.groupBy(key).agg(F.sum("total").alias("known")), "known", limit)
    least = max(1, -(-first // max(parts, 1)))
    heavy = rows.where(F.col("total") >= least).groupBy(key).agg(
        F.sum("total").alias("known"), F.count("*").alias("seen"))
    second = _bar(heavy, "known", limit)
    possible = F.col("known") + (parts - F.col("seen")) * (least - 1)
    return Plan(parts, least, heavy.where(possible >= second).select(key))


def top_keys(partials: DataFrame, key: str, part: str, limit: int = 10, min_reviews: int = 2) -> DataFrame:
    """The keys with most reviews, with counts and percentages per class, as :func:`marts.top_keys` has them."""
    found = plan(partials, key, part, limit)
    return marts.top_of(marts.summed(partials.join(found.candidates, key, "left_semi"), key), key, limit, min_reviews)


def rows_used(partials: DataFrame, key: str, part: str, limit: int = 10) -> DataFrame:
    """Rows of the partials, those that the second phase sums, and those of the third."""
    found = plan(partials, key, part, limit)
    third = partials.join(found.candidates.withColumn("_candidate", F.lit(True)), key, "left")
    return third.agg(
        F.count("*").alias("rows"), F.count_if(F.col(key).isNotNull() & (F.col("total") >= found.least)).alias("heavy_rows"),
        F.count("_candidate").alias("candidate_rows"))
