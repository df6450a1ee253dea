"""Mixing sources to target weights with distributed prefix sums of word counts.

Every document gets a hash-random key; within its source, documents are ordered by that key. The
keys are cut into equal ranges. Words per source and range are summed in Spark, their running sums
find the one range in which the source's budget ends, and only the documents of that range are
ordered to find the document at which it ends. A budget above the source's size repeats whole
epochs and cuts the last one. The result of all this is one row per source, joined to the documents.

Sources are ordered by code point, NULL last; they weigh ``WEIGHTS`` in turn and share ``SHARE`` of
all words. No source may take more than ``MAX_EPOCHS`` times its size; what is above is shared again
by weight among the others, until none is above (water filling: targets are min(cap, level * weight)).

Defined results: NULL text has size 0 and takes 0; a source without words has target 0; rows that
agree in key, id and size and lie on the cut share the rest evenly, rounded down; an empty table
gives no rows. The mix does not depend on the order of rows or files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_pulse.llm.shared import packed, stored, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
RANGE_DIGITS = 3  # hex digits of the key that name a range: 4,096 ranges a source


def sized(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep``, the document's size in words and its random key."""
    return documents.select(
        F.struct(*keep).alias("kept_columns"), F.col("source").alias("mix_source"),
        word_count(F.col("text")).alias("size"), key_columns()[0], F.col("doc_id").alias("mix_id"),
    )


def key_columns() -> tuple[Column, Column]:
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return F.substring(key, 1, 16).alias("key"), F.substring("key", 1, RANGE_DIGITS).alias("part")


def targets(source_sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source_sizes`` (mix_source, source_size) with ``target``; one row per source throughout.

    With sources sorted by cap over weight, the first ones are capped: a source is capped when the
    words left after all before it, spread by the weight left, still exceed its cap.
    """
    by_name = Window.orderBy(F.col("mix_source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    ranked = source_sizes.withColumn("weight", weight.cast("double")).withColumn(
        "cap", F.col("source_size") * float(MAX_EPOCHS))
    ranked = ranked.withColumn("fill", F.col("cap") / F.col("weight")).withColumn(
        "budget", F.sum("source_size").over(everything) * share)
    by_fill = Window.orderBy("fill", F.col("mix_source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levelled = ranked.withColumn("level", level)
    water = F.min(F.when(F.col("level") < F.col("fill"), F.struct("fill", "level"))).over(everything)["level"]
    return levelled.withColumn("water", water).select(
        "mix_source", "source_size",
        F.when(F.col("water").isNull(), F.col("cap")).otherwise(
            F.least("cap", F.col("water") * F.col("weight"))).alias("target"),
    )


def cuts(rows: DataFrame) -> DataFrame:
    """One row per source: size, target, whole epochs, and where the last epoch ends."""
    parts = rows.groupBy("mix_source", key_columns()[1]).agg(F.sum("size").alias("words")).where("words > 0")
    running = Window.partitionBy("mix_source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    summed = stored(parts, "mix-parts")
    sizes = rows.groupBy("mix_source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes).withColumn("taken_words", F.floor("target")).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("taken_words") / F.col("source_size"))).otherwise(0)
    ).withColumn("rest", F.col("taken_words") - F.col("epochs") * F.col("source_size"))
    plan = stored(plan, "mix-plan")
    same = F.col("a.mix_source").eqNullSafe(F.col("b.mix_source"))
    ending = summed.withColumn("done", F.coalesce(F.sum("words").over(running), F.lit(0))).alias("a").join(
        plan.alias("b"), same
    ).where("done < rest and rest <= done + words").select("a.mix_source", "part", (F.col("rest") - F.col("done")).alias("left"))
    inside = rows.withColumn("part", key_columns()[1]).where("size > 0").alias("a").join(
        ending.alias("b"), same & (F.col("a.part") == F.col("b.part"))
    ).groupBy("a.mix_source", "left", "key", "mix_id", "size").agg(F.count("*").alias("rows"))
    ordered = Window.partitionBy("mix_source").orderBy("key", "mix_id", "size")
    place = inside.withColumn("until", F.sum(F.col("size") * F.col("rows")).over(ordered)).withColumn(
        "from", F.col("until") - F.col("size") * F.col("rows")
    ).where("`from` < left and left <= until").select(
        F.col("mix_source").alias("cut_source"), F.struct("key", "mix_id", "size").alias("cut"),
        F.floor((F.col("left") - F.col("from")) / F.col("rows")).alias("at_cut"),
    )
    return plan.join(place, F.col("mix_source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")


def mixed(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with size, the source's size and target, and the words taken."""
    rows = stored(sized(documents, keep), "mix-sizes")
    plan = stored(cuts(rows), "mix-cuts").withColumnRenamed("mix_source", "plan_source")
    here = F.struct("key", "mix_id", "size")
    last = F.when(here < F.col("cut"), F.col("size")).when(here == F.col("cut"), F.col("at_cut")).otherwise(0)
    return rows.join(plan, F.col("mix_source").eqNullSafe(F.col("plan_source"))).select(
        "kept_columns.*", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.coalesce(last, F.lit(0))).cast("long").alias("taken"),
    )


def repeated(documents: DataFrame) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it, whole.

    The document at the cut is taken when at least half of it lies within the budget.
    """
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    counted = mixed(packed(documents), ["whole_row"]).select(F.col("whole_row").alias("d"), times.alias("times"))
    return counted.where("times > 0").select(
        "d", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("epoch")
    ).select("d.*")
