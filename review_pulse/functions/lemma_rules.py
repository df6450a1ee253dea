"""Lemmas learned from pairs of form and lemma: edit rules by the longest known ending.

A pair says how many letters its form loses at the end and what is put there instead. Every ending of the
form that holds those letters votes for that edit, up to ``MAX_ENDING`` letters, and the whole word (marked
by ``^``) does too. An ending keeps the edit with most votes; it needs no rule of its own where the ending one
letter shorter has the same. So the rules are a trie over reversed words, cut down to the nodes at which the
edit changes, and a word takes the edit of its longest ending that has a rule.

Learning is one grouping over the endings. What comes to the driver are the rules, ``max_rules`` at most; they go
into the plan as a literal table in hash buckets, so applying them is narrow.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ENDING = 5
START = "^"
BUCKETS = 1024


@dataclass(frozen=True)
class Rule:
    ending: str
    cut: int
    added: str


def edits(pairs: DataFrame) -> DataFrame:
    """``ending``, ``cut`` and ``added`` for every ending of every pair of ``form`` and ``lemma``."""
    least = F.least(F.length("form"), F.length("lemma"))
    same = F.size(F.filter(F.sequence(F.lit(0), least), lambda i: (i > 0) & (
        F.col("form").substr(F.lit(1), i) == F.col("lemma").substr(F.lit(1), i))))
    cut = (F.length("form") - same).alias("cut")
    known = pairs.where(F.col("form").isNotNull() & F.col("lemma").isNotNull() & (F.length("form") > 0)).select(
        "form", cut, F.col("lemma").substr(same + 1, F.length("lemma")).alias("added"))
    lengths = F.filter(F.sequence(F.lit(1), F.least(F.length("form"), F.lit(MAX_ENDING))), lambda n: n >= F.col("cut"))
    endings = F.concat(F.transform(lengths, lambda n: F.right("form", n)), F.array(F.concat(F.lit(START), "form")))
    return known.select("cut", "added", F.explode(endings).alias("ending"))


def learn(pairs: DataFrame, max_rules: int = 20_000) -> list[Rule]:
    """The rules of a table of pairs; a pair that repeats votes again. Ties go to the shorter cut, then by letters."""
    votes = edits(pairs).groupBy("ending", "cut", "added").agg(F.count("*").alias("n"))
    order = Window.partitionBy("ending").orderBy(F.desc("n"), "cut", "added")
    best = votes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == 1).select("ending", "cut", "added")
    shorter = best.select(F.col("ending").alias("parent"), F.col("cut").alias("parent_cut"), F.col("added").alias("parent_added"))
    whole = F.col("ending").startswith(START)
    rest = F.expr("substring(ending, 2)")
    parent = F.when(whole, F.right(rest, F.lit(MAX_ENDING))).otherwise(rest)
    needed = best.withColumn("parent", parent).join(shorter, "parent", "left").where(
        F.col("parent_cut").isNull() | (F.col("cut") != F.col("parent_cut")) | (F.col("added") != F.col("parent_added")))
    rows = needed.select("ending", "cut", "added").limit(max_rules + 1).collect()
    if len(rows) > max_rules:
        raise ValueError(f"more than {max_rules} rules; learn from fewer pairs or raise max_rules")
    return sorted((Rule(*r) for r in rows), key=lambda r: r.ending)


def _place(ending: Column) -> Column:
    return F.pmod(F.xxhash64(ending), F.lit(BUCKETS)).cast("int")


def applier(rules: list[Rule], places: DataFrame):
    """A function from a column with a word to its lemma. ``places`` is any frame of the session that is used."""
    slots: list[list[dict]] = [[] for _ in range(BUCKETS)]
    spark = places.sparkSession
    if rules:
        rows = spark.createDataFrame([(r.ending, r.cut, r.added) for r in rules], "ending string, cut int, added string")
        for r in rows.withColumn("place", _place(F.col("ending"))).collect():
            slots[r["place"]].append({"ending": r["ending"], "cut": r["cut"], "added": r["added"]})
    table = F.from_json(F.lit(json.dumps(slots)), "array<array<struct<ending: string, cut: int, added: string>>>")

    def found(ending: Column) -> Column:
        return F.get(F.filter(F.get(table, _place(ending)), lambda r: r["ending"] == ending), F.lit(0))

    def lemma(word: Column) -> Column:
        tried = F.concat(F.array(F.concat(F.lit(START), word)), F.transform(
            F.sequence(F.least(F.length(word), F.lit(MAX_ENDING)), F.lit(1), F.lit(-1)), lambda n: F.right(word, n)))
        hits = F.filter(F.transform(tried, found), lambda r: r.isNotNull())
        changed = F.transform(hits, lambda r: F.concat(word.substr(F.lit(1), F.length(word) - r["cut"]), r["added"]))
        return F.when(F.length(word) > 0, F.coalesce(F.get(changed, F.lit(0)), word)).otherwise(word)

    return lemma
