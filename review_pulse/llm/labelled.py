"""A bounded, reproducible sample of labelled texts to fit classifiers on."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_pulse.llm.shared import held_out


@dataclass
class Sample:
    texts: list[str]
    labels: np.ndarray
    prior: float  # log-odds of label 1 among all rows that may be learned from
    shift: float  # to add to log-odds learned from the sample


def training_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int = 2000,
                    max_chars: int = 50_000, class_chars: int = 16_000_000) -> Sample:
    """At most ``per_class`` texts of either label, ``class_chars`` together, chosen by a hash of their id.

    Rows that are held out, have no label of 0 or 1, or a text above ``max_chars`` are not used; an
    id with both labels counts as 1, the least text of an id that repeats stands for it, and equal
    texts are used once. The bounds are what keeps the sample small enough for the driver to fit on.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    chosen = [usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = [(r["doc_id"], r["y"]) for some in chosen for r in some.collect()]
    spark = documents.sparkSession
    few = spark.createDataFrame(ids, "doc_id long, y int")
    rows = documents.where(F.length("text") <= max_chars).select("doc_id", "text").join(F.broadcast(few), "doc_id")
    rows = rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")).persist()
    sizes = {r["doc_id"]: r["size"] for r in rows.select("doc_id", F.length("text").alias("size")).collect()}
    fitting, room = [], {0: class_chars, 1: class_chars}
    for doc_id, label in ids:  # in the order of the hash
        if doc_id in sizes and sizes[doc_id] <= room[label]:
            room[label] -= sizes[doc_id]
            fitting.append((doc_id,))
    wanted = F.broadcast(spark.createDataFrame(fitting, "doc_id long"))
    once = {r["text"]: r for r in sorted(rows.join(wanted, "doc_id").collect(), key=lambda r: -r["doc_id"])}
    rows.unpersist()
    found = sorted((r["doc_id"], r["y"], r["text"]) for r in once.values())
    y = np.array([r[1] for r in found], float)
    prior = float(np.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5)))
    return Sample([r[2] for r in found], y, prior, prior - float(np.log((y.sum() + 0.5) / ((1 - y).sum() + 0.5))))
