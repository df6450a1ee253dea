"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_pulse.llm import (
    byte_bpe, byte_cnn, chat_format, decontaminate, exact_topk, language_id, lexical, masked_lm, minhash_dedup, mixing,
    quality_rules, spelling, toxic_crf,
)
from review_pulse.llm.labelled import training_sample
from review_pulse.llm.shared import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    scored = masked_lm.scored(documents, masked_lm.train(documents), ["doc_id"])
    return scored.withColumn("mean_log_prob", F.col("log_prob") / F.nullif(F.col("n_tokens"), F.lit(0)))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(_table(spark, sf_dir, "documents"), ["doc_id"])


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"), ["doc_id"])


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _predictions(scored: DataFrame, least: float) -> DataFrame:
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"))


def op5_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = toxic_crf.fit(training_sample(documents, _table(spark, sf_dir, "labels"), "toxic"))
    return _predictions(toxic_crf.scored(documents, model, ["doc_id"]), 0.5)


def op6_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = byte_cnn.fit(training_sample(documents, _table(spark, sf_dir, "labels"), "quality"))
    return _predictions(byte_cnn.scored(documents, model, ["doc_id"]), 0.3)


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.marked(_table(spark, sf_dir, "documents"), width=4, threshold=0.8)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, ["doc_id"])


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = language_id.identified(_table(spark, sf_dir, "documents"), ["doc_id"])
    return named.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = r"\### Assistant: </turn> ok"
    tricky = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select(tricky.columns).unionByName(tricky)
    turns = chat_format.canonical(chat_format.as_records(rows), "conv_id")
    return chat_format.digests(chat_format.formatted(turns, "conv_id"), "conv_id")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(_table(spark, sf_dir, "documents"), slips=31))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.judged(documents, benchmark, ["doc_id"])


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_masked_lm, op2_quality_rules, op3_source_mix, op4_exact_topk, op5_toxic_crf, op6_byte_cnn, op7_minhash_dedup, op8_byte_bpe, op9_language_id,
    op10_chat_format, op11_spelling_variants, op12_decontamination, op13_lexical_search,
)}
