"""A training corpus from raw documents: five stages, each written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_pulse.llm import byte_bpe, language_id, minhash_dedup, mixing, quality_rules
from review_pulse.llm.shared import packed, remove, stored

MIN_LANGUAGE_SCORE = 0.5
BATCH_BYTES = "8m"  # of whole texts that a Python worker gets at once


def _bounded(spark: SparkSession) -> None:
    """Batches of whole texts by their bytes: ten thousand rows, Spark's own bound, may be long ones."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a probability of at least MIN_LANGUAGE_SCORE.

    ``lang`` holds the predicted language from here on: the quality rules go by it.
    """
    _bounded(spark)
    named = language_id.identified(packed(docs), ["whole_row"])
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    own = [F.col("lang_pred").alias(c) if c == "lang" else F.col("whole_row")[c].alias(c) for c in docs.columns]
    return named.where(known).select(*own)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the distribution rules keep."""
    _bounded(spark)
    return quality_rules.judged(packed(docs), ["whole_row"]).where("kept").select("whole_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    _bounded(spark)
    return minhash_dedup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    _bounded(spark)
    return mixing.repeated(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and source of each document, its token ids, and the length of the decoded bytes."""
    _bounded(spark)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "source"])


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("near_dedup", drop_near_duplicates),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenize),
]

ORACLE_SQL = None  # a learned language model and MinHash have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            remove(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
