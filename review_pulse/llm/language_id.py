"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed 2- and 3-grams per language are summed over all rows that may be learned from,
inside Spark; the matrix of log-probabilities (languages x buckets, bounded by two parameters) is
broadcast, and each batch of texts is scored in numpy through prefix sums of looked-up values. With more
than ``BLOCK`` languages the matrix is cut into blocks, and the texts pass one block after another
with the best language and the summed probability so far; no language is left out.

Defined results: NULL or empty text, and one in which no character is a letter by Unicode category, is ``und`` with score 0; ties go to the first
language in code-point order; repeated rows are scored alike; without any labelled row every text
is ``und``; other columns, whatever their names, do not matter. Texts are read whole, piece by
piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_pulse.llm.shared import held_out, stored

UNKNOWN = "und"
ORDERS = (2, 3)
PIECE = 1 << 17
BLOCK = 256
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@dataclass
class Model:
    """A block of languages."""
    languages: list[str]
    log_prob: np.ndarray  # languages x buckets
    prior: np.ndarray


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Code points of pieces of texts, where each piece starts, and the text it belongs to.

    A text longer than ``PIECE`` is cut into pieces that overlap by one n-gram less one character,
    so that every n-gram is in exactly one piece; ``_ngrams`` leaves shorter ones of the overlap out.
    """
    codes, owners, size = [], [], 0
    for owner, text in enumerate(texts):
        whole = _codes(text or "")
        for low in range(0, max(1, len(whole)), PIECE):
            part = whole[low : low + PIECE + max(ORDERS) - 1]
            codes.append(part)
            owners.append(owner)
            size += len(part)
            if size >= PIECE:
                yield _joined(codes, owners)
                codes, owners, size = [], [], 0
    if codes:
        yield _joined(codes, owners)


def _joined(codes: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
    return np.concatenate(codes), starts, np.array(owners)


def _ngrams(codes: np.ndarray, starts: np.ndarray, order: int, buckets: int) -> tuple[np.ndarray, ...]:
    """Buckets of all runs of ``order`` characters, and the range of runs that each piece owns."""
    count = max(0, len(codes) - order + 1)
    hashed = np.zeros(count, np.uint32)
    for k in range(order):
        hashed = (hashed + codes[k : k + count]) * _MIX[k]
        hashed ^= hashed >> np.uint32(15)
    low = np.minimum(starts[:-1], count)
    lengths = np.minimum(np.diff(starts) - order + 1, PIECE)
    return hashed % np.uint32(buckets), low, np.minimum(low + np.maximum(0, lengths), count)


def fit(documents: DataFrame, text: str = "text", language: str = "lang", may_learn: Column | None = None,
        buckets: int = 8192) -> list[Model]:
    """Blocks of languages, with counts over every row that has a language and may be learned from."""
    rows = documents.where(F.col(language).isNotNull())
    rows = rows if may_learn is None else rows.where(may_learn)
    counts = rows.groupBy(F.col(language).alias("language")).count().collect()
    number = {r["language"]: r["count"] for r in counts}
    every = sorted(number)
    total = sum(number.values())
    blocks = [every[k : k + BLOCK] for k in range(0, len(every), BLOCK)]
    return [_fit_block(rows, text, language, names, np.array([number[n] for n in names]) / total, buckets) for names in blocks]


def _fit_block(rows: DataFrame, text: str, language: str, names: list[str], share: np.ndarray, buckets: int) -> Model:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(names) * buckets, np.int64)
        index = {name: k for k, name in enumerate(names)}
        for batch in batches:
            labels = np.array([index[x] for x in batch.column(1).to_pylist()])
            for codes, starts, owners in _pieces(batch.column(0).to_pylist()):
                for order in ORDERS:
                    ids, low, high = _ngrams(codes, starts, order, buckets)
                    base = np.full(len(ids), -1, np.int64)
                    for a, b, owner in zip(low, high, owners):
                        base[a:b] = labels[owner] * buckets
                    used = base >= 0
                    totals += np.bincount(base[used] + ids[used], minlength=len(totals))
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["cell", "n"])

    learned = rows.where(F.col(language).isin(names)).select(F.col(text).alias("t"), F.col(language).alias("l"))
    cells = learned.mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(names) * buckets)
    counts[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(np.float64)
    smoothed = counts.reshape(len(names), buckets) + 0.5
    return Model(names, np.log(smoothed / smoothed.sum(1, keepdims=True)), np.log(share))


def log_scores(model: Model, texts: list[str | None]) -> np.ndarray:
    """Joint log-probability of each text (row) with each language (column)."""
    out = np.tile(model.prior, (len(texts), 1))
    buckets = model.log_prob.shape[1]
    for codes, starts, owners in _pieces(texts):
        for order in ORDERS:
            ids, low, high = _ngrams(codes, starts, order, buckets)
            sums = np.zeros(len(ids) + 1)
            for k, table in enumerate(model.log_prob):
                np.cumsum(table[ids], out=sums[1:])
                np.add.at(out[:, k], owners, sums[high] - sums[low])
    return out


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def identify(documents: DataFrame, models: list[Model], keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``lang_pred`` and ``score``, the probability of the language named."""
    rows = documents.select(
        F.struct(*keep).alias("kept"), F.col(text).alias("t"), F.lit(UNKNOWN).alias("lang_pred"),
        F.lit(float("-inf")).alias("best"), F.lit(float("-inf")).alias("total"))
    for k, model in enumerate(models):
        rows = _identify_block(stored(rows, "language-block") if k else rows, model, last=k + 1 == len(models))
    score = F.when(F.col("best") == float("-inf"), 0.0).otherwise(F.exp(F.col("best") - F.col("total")))
    return rows.select("kept.*", "lang_pred", score.alias("score"))


def _identify_block(rows: DataFrame, model: Model, last: bool) -> DataFrame:
    """The best language so far, its log-probability and that of all languages so far together.

    The texts are passed on unless this is the last block.
    """
    shared = rows.sparkSession.sparkContext.broadcast((model.languages, model.log_prob, model.prior))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            texts, names = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            bests, totals = (batch.column(k).to_numpy(zero_copy_only=False).copy() for k in (3, 4))
            known = [i for i, t in enumerate(texts) if has_letter(t)]
            if known:
                logs = log_scores(model, [texts[i] for i in known])
                most = logs.max(1)
                totals[known] = np.logaddexp(totals[known], most + np.log(np.exp(logs - most[:, None]).sum(1)))
                for i, k, log in zip(known, logs.argmax(1), most):
                    if log > bests[i]:
                        names[i], bests[i] = model.languages[k], log
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(bests), pa.array(totals)],
                batch.schema.names)
            yield out.drop_columns(["t"]) if last else out

    return rows.mapInArrow(scored, rows.drop("t").schema if last else rows.schema)


def identified(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Fit on the rows that are not held out and name the language of all rows."""
    return identify(documents, fit(documents, may_learn=~held_out(F.col("doc_id"))), keep)
