"""Text features: relational term statistics and the MLlib stages used for training."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    HashingTF,
    NGram,
    Normalizer,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_pulse.functions import hashing
from review_pulse.functions.text import ngrams

# Sizes of the hashed feature spaces and of the vocabulary.
HASHED_SIZE = 1_000
HASHED_SIZE_WIDE = 10_000
VOCABULARY_SIZE = 5_000
MIN_TERM_CHARS = 2
TERM_BUCKETS = 4_096  # of the table that a term's weight is looked up in


def document_frequency(df: DataFrame, words: str) -> DataFrame:
    """Documents per term. Terms are made distinct inside the row, so only counts are shuffled."""
    terms = df.select(F.explode(F.array_distinct(F.col(words))).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("doc_freq"))


def idf_terms(df: DataFrame, words: str) -> DataFrame:
    """``ln((N + 1) / (df + 1))`` per term, N being the number of rows."""
    total = df.agg(F.count("*")).scalar()
    frequency = document_frequency(df, words)
    return frequency.withColumn("idf", F.log((total + 1.0) / (F.col("doc_freq") + 1.0)))


def row_counts(words: Column) -> Column:
    """``array<struct<term, tf>>`` of the words of a row, by term; short words are left out.

    The words are sorted, and a term's count is the distance between its first place and the next term's.
    """
    def counted(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        firsts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return F.transform(F.array(firsts), lambda begun: F.transform(begun, lambda i, k: F.struct(
            F.get(ordered, i).alias("term"),
            (F.coalesce(F.get(begun, k + 1), F.size(ordered)) - i).cast("bigint").alias("tf"))))[0]

    kept = F.sort_array(F.filter(words, lambda w: F.length(w) >= MIN_TERM_CHARS))
    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    return F.transform(F.array(kept), lambda ordered: F.when(F.size(ordered) > 0, counted(ordered)).otherwise(empty))[0]


def term_counts(df: DataFrame, row_id: str, words: str) -> DataFrame:
    """Occurrences per row and term: (row, term, tf), counted inside the row. A row is a document of its own."""
    counted = df.select(row_id, F.inline_outer(row_counts(F.col(words))))
    return counted.where("term IS NOT NULL")  # inline() lets Spark repeat the counting in a filter


def vocabulary(counts: DataFrame, size: int = VOCABULARY_SIZE) -> DataFrame:
    """The ``size`` terms with most occurrences (ties by term) out of :func:`term_counts`."""
    totals = counts.groupBy("term").agg(F.sum("tf").alias("total_tf"), F.count("*").alias("doc_freq"))
    return totals.orderBy(F.desc("total_tf"), F.asc("term")).limit(size)


def vocab_tfidf(df: DataFrame, row_id: str, words: str, size: int = VOCABULARY_SIZE) -> DataFrame:
    """Smoothed TF-IDF over the top terms, each row scaled to unit length: (row, term, tf, tfidf).

    Words are counted inside their row; what is shuffled is one total per term and task. The ``size`` terms
    and their weights come back as a literal table, in buckets by hash, so a term is found without a
    join and a row never leaves its partition.
    """
    total = df.agg(F.count("*")).scalar()
    idf = F.log((total + 1.0) / (F.col("doc_freq") + 1.0)) + 1.0
    place = lambda term: F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")
    terms = vocabulary(term_counts(df, row_id, words), size).select("term", idf.alias("idf"), place(F.col("term")).alias("place"))
    slots: list[list[dict]] = [[] for _ in range(TERM_BUCKETS)]
    for r in terms.collect():
        slots[r["place"]].append({"term": r["term"], "idf": r["idf"]})
    table = F.from_json(F.lit(json.dumps(slots)), "array<array<struct<term: string, idf: double>>>")

    def weight(term: Column) -> Column:
        return F.get(F.filter(F.get(table, place(term)), lambda e: e["term"] == term), F.lit(0))["idf"]

    def scaled(entries: Column) -> Column:
        norm = F.sqrt(F.aggregate(entries, F.lit(0.0), lambda s, c: s + c["raw"] * c["raw"]))
        return F.transform(F.array(norm), lambda n: F.transform(
            entries, lambda c: F.struct(c["term"], c["tf"], (c["raw"] / n).alias("tfidf"))))[0]

    raw = F.transform(row_counts(F.col(words)), lambda c: F.struct(c["term"], c["tf"], (c["tf"] * weight(c["term"])).alias("raw")))
    known = F.filter(raw, lambda c: c["raw"].isNotNull())
    out = df.select(row_id, F.inline_outer(F.transform(F.array(known), scaled)[0]))
    return out.where("term IS NOT NULL")


def nonzero(vector: Column) -> Column:
    """``array<struct<index, value>>`` of the non-zero entries of a vector, in order of index.

    The vector's own fields are read from its JSON form, so that sparse ones are never widened.
    """
    fields = F.from_json(F.to_json(F.struct(vector.alias("v"))), "v struct<indices: array<int>, values: array<double>>")
    return F.transform(F.array(fields["v"]), lambda v: F.filter(
        F.zip_with(
            F.coalesce(v["indices"], F.transform(v["values"], lambda _, k: k)), v["values"],
            lambda k, x: F.struct(k.alias("index"), x.alias("value"))),
        lambda entry: entry["value"] != 0))[0]


def hashed_terms(df: DataFrame, row_id: str, words: str, size: int = HASHED_SIZE) -> DataFrame:
    """One row per word, bigram and trigram of a row: (row, space, bucket), as the hashing stages number them.

    ``space`` is 0, 1 or 2; its block of the assembled vector begins at ``space * size``.
    """
    def placed(space: int, grams: Column) -> Column:
        return F.transform(grams, lambda g: F.struct(F.lit(space).alias("space"), g.alias("term")))

    every = [F.col(words), ngrams(F.col(words), 2), ngrams(F.col(words), 3)]
    terms = df.select(row_id, F.inline(F.concat(*[placed(k, grams) for k, grams in enumerate(every)])))
    return hashing.with_bucket(terms, "term", "bucket", size).select(row_id, "space", "bucket")


def hashed_counts(df: DataFrame, row_id: str, words: str, size: int = HASHED_SIZE) -> DataFrame:
    """The hashed count vectors in relational form: (row, space, bucket, n), without zeros."""
    return hashed_terms(df, row_id, words, size).groupBy(row_id, "space", "bucket").agg(F.count("*").alias("n"))


def label_index_frequency(df: DataFrame, label: str = "label") -> DataFrame:
    """Index by falling class size (ties by label). The ranked table has one row per class code."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("n"), F.asc(label))
    return counts.select(label, "n", (F.row_number().over(order) - 1).alias("indexed_label"))


def label_index_alphabetical(df: DataFrame, label: str = "label") -> DataFrame:
    """Index by label order, so that index and class code agree when all classes occur."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.asc(label))
    return counts.select(label, "n", (F.row_number().over(order) - 1).alias("indexed_label"))


def word_stages(text: str = "lemmatized_text") -> list:
    return [
        Tokenizer(inputCol=text, outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words"),
    ]


def ngram_tfidf_stages(size: int = HASHED_SIZE) -> list:
    """Hashed counts of words, bigrams and trigrams side by side, then inverse document frequency.

    IDF works per dimension, so one fit over the assembled vector equals three separate fits.
    """
    return [
        NGram(n=2, inputCol="filtered_words", outputCol="bigrams"),
        NGram(n=3, inputCol="filtered_words", outputCol="trigrams"),
        HashingTF(inputCol="filtered_words", outputCol="tf_uni", numFeatures=size),
        HashingTF(inputCol="bigrams", outputCol="tf_bi", numFeatures=size),
        HashingTF(inputCol="trigrams", outputCol="tf_tri", numFeatures=size),
        VectorAssembler(inputCols=["tf_uni", "tf_bi", "tf_tri"], outputCol="tf"),
        IDF(inputCol="tf", outputCol="features"),
    ]


def bigram_tfidf_stages(size: int = HASHED_SIZE_WIDE) -> list:
    return [
        NGram(n=2, inputCol="filtered_words", outputCol="bigrams"),
        HashingTF(inputCol="bigrams", outputCol="tf", numFeatures=size),
        IDF(inputCol="tf", outputCol="features"),
    ]


def fit_vocabulary(df: DataFrame, text: str = "lemmatized_text", size: int = VOCABULARY_SIZE) -> PipelineModel:
    """Vector form of :func:`vocab_tfidf`: smoothed TF-IDF over the top terms, unit length."""
    front = Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="terms", pattern=r"\s+", minTokenLength=MIN_TERM_CHARS),
        CountVectorizer(inputCol="terms", outputCol="counts", vocabSize=size),
    ]).fit(df)
    idf = IDF(inputCol="counts", outputCol="weighted").fit(front.transform(df)).idf
    scale = ElementwiseProduct(
        inputCol="counts", outputCol="weighted", scalingVec=Vectors.dense(idf.toArray() + 1.0)
    )
    unit = Normalizer(inputCol="weighted", outputCol="features", p=2.0)
    return PipelineModel(stages=[*front.stages, scale, unit])


def label_stage(order: str = "alphabetAsc", on_unknown: str = "error") -> StringIndexer:
    return StringIndexer(
        inputCol="label", outputCol="indexed_label", stringOrderType=order, handleInvalid=on_unknown
    )
