"""Quality classifier: a byte-level convolutional network in numpy.

Filters over ``WIDTH`` bytes are tables of a weight per place and byte value, so that a response is a
sum of looked-up rows. The document is covered by overlapping chunks of bytes; within a chunk each
filter keeps its largest response (rectified), and the mean and the maximum over all chunks go
through one logistic unit. Trained by Adam on a bounded sample of labelled documents.

Defined results: NULL and empty texts are a chunk of padding; if the sample lacks one of the labels,
every text gets the labels' prior; repeated rows score alike. Texts are read whole, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_pulse.llm import bytewise
from review_pulse.llm.labelled import Sample

WIDTH, FILTERS = 5, 12
CHUNK, STRIDE = 256, 192
BLOCK = 256  # chunks that are held at once


@dataclass
class Model:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    out: np.ndarray  # weights of means, of maxima, and the intercept


def chunks_of(length: int) -> int:
    """Chunks that cover a document of that many bytes, one at least."""
    return 1 + max(0, -(-(length - CHUNK) // STRIDE))


def responses(model: Model, windows: np.ndarray) -> np.ndarray:
    """Filter responses at every place of chunks of CHUNK + WIDTH - 1 bytes."""
    out = model.tables[0].take(windows[:, :CHUNK], 0)
    for k in range(1, WIDTH):
        out += model.tables[k].take(windows[:, k : k + CHUNK], 0)
    return out


def windows_of(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each chunk begins and ends in the bytes of all texts, and how many chunks each text has."""
    lengths = np.diff(starts)
    counts = 1 + np.maximum(0, -(-(lengths - CHUNK) // STRIDE))
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.repeat(starts[:-1], counts) + place * STRIDE
    return np.stack([begin, np.repeat(starts[1:], counts)], 1), counts


def cut(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Bytes of the chunks, zero after the end of their text."""
    at = places[:, :1] + np.arange(CHUNK + WIDTH - 1)
    inside = at < places[:, 1:]
    if not len(data):
        return np.zeros(at.shape, np.uint8)
    return data[np.minimum(at, len(data) - 1)] * inside


def document_scores(model: Model, column: pa.Array) -> np.ndarray:
    """Probability of label 1 of each text."""
    data, starts = bytewise.utf8(column)
    places, counts = windows_of(data, starts)
    pooled = np.empty((len(places), FILTERS), np.float32)
    for low in range(0, len(places), BLOCK):
        pooled[low : low + BLOCK] = responses(model, cut(data, places[low : low + BLOCK])).max(1)
    return probabilities(model, np.maximum(pooled + model.bias, 0), counts)[0]


def probabilities(model: Model, pooled: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(counts):
        return np.empty(0), np.empty((0, 2 * FILTERS))
    first = np.cumsum(counts) - counts
    mean = np.add.reduceat(pooled, first).astype(float) / counts[:, None]
    features = np.concatenate([mean, np.maximum.reduceat(pooled, first)], 1)
    return 1 / (1 + np.exp(-np.clip(features @ model.out[:-1] + model.out[-1], -30, 30))), features


def fit(sample: Sample, epochs: int = 5, batch: int = 32, rate: float = 0.01, seed: int = 7) -> Model:
    rng = np.random.default_rng(seed)
    model = Model(rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
                  rng.normal(0, 0.1, 2 * FILTERS + 1))
    y = sample.labels
    if len(set(y)) < 2:
        model.out[:] = 0
        model.out[-1] = sample.prior
        return model
    data, starts = bytewise.utf8(pa.array(sample.texts, pa.string()))
    places, counts = windows_of(data, starts)
    first = np.concatenate([[0], np.cumsum(counts)])
    parameters = [model.tables, model.bias, model.out]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for low in range(0, len(order), batch):
            docs = order[low : low + batch]
            mine = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            bytes_of = cut(data, places[mine])
            raw = responses(model, bytes_of)
            at = raw.argmax(1)
            pooled = np.maximum(np.take_along_axis(raw, at[:, None], 1)[:, 0] + model.bias, 0)
            own = counts[docs]
            p, features = probabilities(model, pooled, own)
            error = (p - y[docs]) / len(docs)
            out_step = np.concatenate([features.T @ error, [error.sum()]])
            begun = np.cumsum(own) - own
            owner = np.repeat(np.arange(len(docs)), own)
            back = error[:, None] * model.out[:-1]
            grad = back[owner, :FILTERS] / own[owner, None]
            top = np.maximum.reduceat(pooled, begun)
            grad += back[owner, FILTERS:] * (pooled == top[owner])
            grad *= pooled > 0
            tables = np.zeros_like(model.tables)
            rows, filters = np.arange(len(mine))[:, None], np.arange(FILTERS)[None]
            for k in range(WIDTH):
                np.add.at(tables[k], (bytes_of[rows, at + k], filters), grad)
            step += 1
            for value, change, (m, v) in zip(parameters, (tables, grad.sum(0), out_step), moments):
                m += 0.1 * (change - m)
                v += 0.01 * (change**2 - v)
                value -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(value.dtype)
    model.out[-1] += sample.shift
    return model


def scored(documents: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``score``, the probability of label 1 of the whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            scores = document_scores(model, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["kept", "score"])

    pairs = documents.select(F.struct(*keep).alias("kept"), F.col(text).alias("t"))
    schema = pairs.select("kept", F.lit(0.0).alias("score")).schema
    return pairs.mapInArrow(run, schema).select("kept.*", "score")
