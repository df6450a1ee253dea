"""Class weights, rebalancing and splitting, all keyed by a seeded hash of the row id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_pulse.functions import hashing
from review_pulse.functions.labels import NEGATIVE, NEUTRAL, POSITIVE, valid_labels
from review_pulse.operators.profile import class_distribution

# The majority class may be at most this many times the negative class.
MAJORITY_FACTOR = 3
DIGEST_DIGITS = 32
BUCKET_DIGITS = 4  # digits of a hash that are counted at once
SPLIT_SEED = 42


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``total / n`` per class. The window runs over the grouped rows, one per class code."""
    counts = valid_labels(df, label).groupBy(label).agg(F.count("*").alias("n"))
    everything = Window.partitionBy(F.lit(0))
    return counts.select(label, "n", (F.sum("n").over(everything) / F.col("n")).alias("weight"))


def with_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Add ``weight``; rows outside the three classes get 1.0. The weights table has three rows at most."""
    weights = class_weights(df, label).select(label, "weight")
    return df.join(F.broadcast(weights), label, "left").fillna({"weight": 1.0})


@dataclass(frozen=True)
class RebalancePlan:
    """Row counts per class and what the rebalancing does with each of them."""

    counts: dict[int, int]

    @property
    def target(self) -> int:
        """Rows of the positive class to keep: all of them where there are no negative rows to go by."""
        positive = self.counts.get(POSITIVE, 0)
        negative = self.counts.get(NEGATIVE, 0)
        return min(MAJORITY_FACTOR * negative, positive) if negative else positive

    def copies(self, label: int) -> int:
        """How often each row of a minority class appears; an empty class stays empty."""
        n = self.counts.get(label, 0)
        return max(1, self.target // n) if n else 1

    @property
    def keep_below(self) -> int:
        """Draws under this value keep a positive row."""
        positive = self.counts.get(POSITIVE, 0)
        return hashing.HASH_SPACE * self.target // positive if positive else 0


def rebalance_plan(df: DataFrame, label: str = "label") -> RebalancePlan:
    """One grouped count; the driver reads back one row per class, three at most."""
    rows = class_distribution(valid_labels(df, label), label).collect()
    return RebalancePlan({int(row[label]): row["n"] for row in rows})


def keep_fraction(df: DataFrame, plan: RebalancePlan, row_id: str, seed: int, label: str = "label") -> DataFrame:
    """Positive rows whose draw falls below the threshold: narrow, about ``target`` rows."""
    kept = hashing.draw32(F.col(row_id), seed) < plan.keep_below
    return df.where((F.col(label) != POSITIVE) | kept)


@dataclass(frozen=True)
class Cut:
    """Where the hash order is cut: the last digest kept, how many rows share it, how many of those stay."""

    digest: str
    rows: int
    room: int


def _boundary(sizes: DataFrame, key: str, target: int):
    """The first group, in key order, at which the running total reaches ``target``."""
    running = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy(key))
    before = sizes.withColumn("before", running - F.col("n"))
    return before.where((F.col("before") < target) & (F.col("before") + F.col("n") >= target)).first()


def hash_cut(rows: DataFrame, row_id: str, target: int, seed: int) -> Cut | None:
    """Where to cut the hash order of ``rows`` so that ``target`` of them come first.

    Grouped counts over the next ``BUCKET_DIGITS`` digits of the hash, each time inside the bucket that the
    cut falls into, until that bucket is as small as a list of buckets; its digests are counted
    last. No running total sees more than that, and copies of an id are counted, never gathered.
    """
    inside = rows.select(hashing.seeded_md5(F.col(row_id), seed).alias("digest"))
    room, digits = target, 0
    while digits < DIGEST_DIGITS:
        digits += BUCKET_DIGITS
        leading = F.substring("digest", 1, digits)
        found = _boundary(inside.groupBy(leading.alias("leading")).agg(F.count("*").alias("n")), "leading", room)
        if found is None:  # nothing to keep, or fewer rows than wanted
            return None
        inside, room = inside.where(leading == found["leading"]), room - found["before"]
        if found["n"] <= 16**BUCKET_DIGITS:
            break
    last = _boundary(inside.groupBy("digest").agg(F.count("*").alias("n")), "digest", room)
    return Cut(last["digest"], last["n"], room - last["before"])


def keep_exact(df: DataFrame, plan: RebalancePlan, row_id: str, seed: int, label: str = "label") -> DataFrame:
    """Exactly ``target`` positive rows, the first ones in hash order: a filter, no sort.

    Where ids repeat and the cut falls between copies of one id, any of those copies are taken.
    """
    positive = F.col(label) == POSITIVE
    if plan.target == plan.counts.get(POSITIVE, 0):
        return df
    cut = hash_cut(df.where(positive), row_id, plan.target, seed)
    if cut is None:
        return df.where(~positive)
    digest = hashing.seeded_md5(F.col(row_id), seed)
    if cut.room == cut.rows:
        return df.where(~positive | (digest <= cut.digest))
    sure = df.where(~positive | (digest < cut.digest))
    return sure.unionByName(df.where(positive & (digest == cut.digest)).limit(cut.room))


def oversample(df: DataFrame, plan: RebalancePlan, label: str = "label", copy_column: str = "copy") -> DataFrame:
    """Repeat minority rows; ``copy_column`` numbers the copies of a row from 1.

    A single generator per row instead of a union per copy.
    """
    copies = {code: plan.copies(code) for code in (NEGATIVE, NEUTRAL)}
    n = F.lit(1)
    for code, times in copies.items():
        n = F.when(F.col(label) == code, F.lit(times)).otherwise(n)
    return df.withColumn(copy_column, F.explode(F.sequence(F.lit(1), n)))


def rebalance(
    df: DataFrame,
    row_id: str,
    seed: int = SPLIT_SEED,
    exact: bool = False,
    label: str = "label",
) -> DataFrame:
    """Thin out the positive class and repeat the others towards its size."""
    valid = valid_labels(df, label)
    plan = rebalance_plan(valid, label)
    keep = keep_exact if exact else keep_fraction
    return oversample(keep(valid, plan, row_id, seed, label), plan, label)


def split_name(row_id: Column, seed: int = SPLIT_SEED) -> Column:
    """train / validation / test in proportion 80 / 10 / 10."""
    draw = hashing.draw32(row_id, seed) % 10
    return F.when(draw < 8, "train").when(draw == 8, "validation").otherwise("test")


def with_split(df: DataFrame, row_id: str, seed: int = SPLIT_SEED) -> DataFrame:
    return df.withColumn("split", split_name(F.col(row_id), seed))


def random_split(df: DataFrame, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spark's own sampling split; depends on the partitioning, so runs may differ."""
    train, rest = df.randomSplit([0.8, 0.2], seed=seed)
    validation, test = rest.randomSplit([0.5, 0.5], seed=seed)
    return train, validation, test


def shuffled(df: DataFrame, row_id: str, seed: int = SPLIT_SEED) -> DataFrame:
    """Rows in a reproducible random order; a full sort, only for exports that need it."""
    return df.orderBy(hashing.seeded_md5(F.col(row_id), seed), row_id)
