"""Masked pseudo-likelihood: a bidirectional window network predicts every token from both sides.

Tokens are lower-cased words. The ``VOCABULARY`` most frequent of the whole corpus (counted in Spark)
have a number of their own; all others are predicted as one, REST, and then spelled byte by byte by a
model of byte pairs, so that every word has a probability of its own. As context, rare words go
to one of ``SHADES`` hashed numbers. The words up to ``SPAN`` places before and after a position, each
through a matrix of its own place, make one hidden vector; it predicts the class and, given the class,
the member of the word in the middle, which it never sees. A document's score is the sum of these
conditional log-probabilities over all its words.

Training reads every document and predicts every position once. Runs of texts are dealt over the rounds;
every task trains a copy of the network on its runs of the round with AdaGrad, and the copies are
averaged in Spark, weighted by positions, in a tree: no task and no driver sees more than ``FAN`` of
them at once. Which texts share a run depends on files and partitions, so another layout gives
slightly other weights, and scores; the same layout gives the same.

The vocabulary and the network have a fixed size, whatever the corpus; only they come to the driver.

Defined results: NULL, empty or blank text has no tokens and a log-probability of 0; the context
beyond either end of a text is an end mark; repeated rows score alike; for a table without words
the untrained network is used. Texts are read whole, in slices of positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_pulse.llm import bytewise

CLASSES, MEMBERS = 64, 64
REST = 0  # the target that stands for all words without a number
VOCABULARY = CLASSES * MEMBERS - 1
SHADES = 1 << 12
END = CLASSES * MEMBERS + SHADES  # the mark beyond either end
HIDDEN = 16
SPAN = 3
OFFSETS = tuple(o for o in range(-SPAN, SPAN + 1) if o)
ROUNDS = 2  # each trains on its share of the runs, together on all
STEP = 1 << 12  # positions of a training step, and of a slice when scoring
FAN = 32

_SHAPES = {
    "embed": (END + 1, HIDDEN), "place": (len(OFFSETS), HIDDEN, HIDDEN), "bias": (HIDDEN,),
    "classes": (HIDDEN + 1, CLASSES), "members": (CLASSES, HIDDEN + 1, MEMBERS),
}


@dataclass
class Network:
    """All weights in one vector; the last row of ``classes`` and ``members`` are their biases."""
    flat: np.ndarray

    def __getattr__(self, name: str) -> np.ndarray:
        at = 0
        for key, shape in _SHAPES.items():
            size = int(np.prod(shape))
            if key == name:
                return self.flat[at : at + size].reshape(shape)
            at += size
        raise AttributeError(name)


@dataclass
class Model:
    """Hashes of the numbered words, sorted, with their numbers; the network; log-probabilities of byte pairs."""
    hashes: np.ndarray
    numbers: np.ndarray
    network: Network
    spelling: np.ndarray  # of the second byte given the first; byte 0x20 stands before and after a word


def untrained(seed: int = 11) -> Network:
    network = Network(np.zeros(sum(int(np.prod(s)) for s in _SHAPES.values()), np.float32))
    rng = np.random.default_rng(seed)
    for name in ("embed", "place", "classes", "members"):
        part = getattr(network, name)
        part[:] = rng.normal(0, 0.25, part.shape)
    network.classes[-1], network.members[:, -1] = 0, 0
    return network


def blank_model() -> Model:
    return Model(np.empty(0, np.uint64), np.empty(0, np.int64), untrained(), np.full((256, 256), -np.log(256)))


def _word_runs(column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Lower-cased bytes, begin, end and hash of the words of runs of texts, and each text's first word."""
    data, starts = bytewise.utf8(column)
    for low, high in bytewise.groups(starts):
        some = bytewise.LOWER[data[starts[low] : starts[high]]]
        begin, end, first = bytewise.spans(some, starts[low : high + 1] - starts[low], ~bytewise.IS_SPACE)
        yield some, begin, end, bytewise.hash_spans(some, begin, end), first


def numbered(model: Model, hashes: np.ndarray) -> np.ndarray:
    """The number of each word: its own, or for a rare word the one of its shade."""
    if not len(model.hashes):
        return CLASSES * MEMBERS + (hashes % np.uint64(SHADES)).astype(np.int64)
    at = np.minimum(np.searchsorted(model.hashes, hashes), len(model.hashes) - 1)
    shade = CLASSES * MEMBERS + (hashes % np.uint64(SHADES)).astype(np.int64)
    return np.where(model.hashes[at] == hashes, model.numbers[at], shade)


def padded_runs(model: Model, column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """Word numbers with SPAN end marks around each text, each text's first place, and how each word is spelled."""
    for data, begin, end, hashes, first in _word_runs(column):
        counts, texts = np.diff(first), len(first) - 1
        room = SPAN * np.arange(1, texts + 1)
        padded = np.full(len(hashes) + SPAN * (texts + 1), END, np.int64)
        padded[np.arange(len(hashes)) + np.repeat(room, counts)] = numbered(model, hashes)
        yield padded, np.append(first[:-1] + room, len(padded)), (data, begin, end)


def spelled(model: Model, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The log-probability of each word's bytes, one after another, up to its end."""
    before = np.empty(len(data), np.uint8)
    before[1:] = data[:-1]
    before[begin] = 0x20
    sums = np.concatenate([[0], np.cumsum(model.spelling[before, data])])
    return sums[end] - sums[begin] + model.spelling[data[end - 1], 0x20]


def pair_counts(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How often each pair of bytes occurs in some words, with the space around each."""
    sizes = end - begin
    starts = np.cumsum(sizes) - sizes
    flat = data[np.repeat(begin - starts, sizes) + np.arange(int(sizes.sum()))].astype(np.int64)
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[starts] = 0x20
    pairs = np.bincount(before * 256 + flat, minlength=1 << 16)
    return pairs + np.bincount(data[end - 1].astype(np.int64) * 256 + 0x20, minlength=1 << 16)


def positions_of(padded: np.ndarray) -> np.ndarray:
    return np.flatnonzero(padded != END)


def targets_of(padded: np.ndarray) -> np.ndarray:
    return np.where(padded < CLASSES * MEMBERS, padded, REST)


def _shifted(rows: np.ndarray, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Views of the rows that have a row ``offset`` further on, and of those further on."""
    return (rows[: len(rows) - offset], rows[offset:]) if offset > 0 else (rows[-offset:], rows[: len(rows) + offset])


def _hidden(network: Network, context: np.ndarray) -> np.ndarray:
    """Hidden vectors of all places of a slice, given the embeddings of its tokens; the last column, of ones, meets the biases."""
    inner = np.tile(network.bias, (len(context), 1))
    for offset, place in zip(OFFSETS, network.place):
        mine, ahead = _shifted(inner, offset)[0], _shifted(context, offset)[1]
        mine += ahead @ place
    out = np.ones((len(context), HIDDEN + 1), np.float32)
    np.tanh(inner, out=out[:, :-1])
    return out


def _by_class(targets: np.ndarray) -> tuple[np.ndarray, list[slice]]:
    """An order of the targets by class, and the part of that order which each class takes."""
    cls = (targets // MEMBERS).astype(np.uint8)
    order = np.argsort(cls, kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
    return order, [slice(a, b) for a, b in zip(bounds, bounds[1:])]


_ONES = np.ones(max(CLASSES, MEMBERS), np.float32)


def log_probabilities(network: Network, padded: np.ndarray) -> np.ndarray:
    """The log-probability of the number (or of REST) of each word, given the tokens around it."""
    classes, members, embed = network.classes, network.members, network.embed
    found = [np.empty(0)]
    for low in range(0, len(padded) - 2 * SPAN, STEP):
        part = padded[low : low + STEP + 2 * SPAN]
        at = SPAN + positions_of(part[SPAN : len(part) - SPAN])
        targets = targets_of(part[at])
        order, own = _by_class(targets)
        targets, row = targets[order], np.arange(len(at))
        h = _hidden(network, embed.take(part, 0))[at[order]]
        logits = h @ classes
        mine = logits[row, targets // MEMBERS] - np.log(np.exp(logits, out=logits) @ _ONES[:CLASSES])
        for some, weights in zip(own, members):
            np.matmul(h[some], weights, out=logits[some])
        mine += logits[row, targets % MEMBERS] - np.log(np.exp(logits, out=logits) @ _ONES[:MEMBERS])
        out = np.empty(len(at))
        out[order] = mine
        found.append(out)
    return np.concatenate(found)


def train_step(network: Network, squares: Network, padded: np.ndarray, rate: float) -> int:
    """One AdaGrad step on all places of a slice but the SPAN at either end; gives their number."""
    at = SPAN + positions_of(padded[SPAN : len(padded) - SPAN])
    if not len(at):
        return 0
    embed, classes, members = network.embed, network.classes, network.members
    grad = Network(np.zeros_like(network.flat))
    targets = targets_of(padded[at])
    order, own = _by_class(targets)
    at, targets, row = at[order], targets[order], np.arange(len(at))
    context = embed.take(padded, 0)
    h = _hidden(network, context)[at]

    def error_of(logits: np.ndarray, right: np.ndarray) -> np.ndarray:
        np.exp(logits, out=logits)
        logits *= (1 / (logits @ _ONES[: logits.shape[1]]))[:, None]
        logits[row, right] -= 1
        return logits

    error = error_of(h @ classes, targets // MEMBERS)
    grad.classes[:] = h.T @ error
    back = error @ classes[:-1].T
    for some, weights in zip(own, members):
        np.matmul(h[some], weights, out=error[some])
    error = error_of(error, targets % MEMBERS)
    for some, weights, step in zip(own, members, grad.members):
        np.matmul(h[some].T, error[some], out=step)
        back[some] += error[some] @ weights[:-1].T
    back *= 1 - h[:, :-1] ** 2
    grad.bias[:] = back.sum(0)
    placed = np.zeros((len(padded), HIDDEN), np.float32)
    placed[at] = back
    returned = np.zeros_like(placed)  # what each token of the slice gets back from the places around it
    for offset, place, step in zip(OFFSETS, network.place, grad.place):
        (mine, _), (_, ahead) = _shifted(placed, offset), _shifted(context, offset)
        step[:] = ahead.T @ mine
        into = _shifted(returned, offset)[1]
        into += mine @ place.T
    order = np.argsort(padded.astype(np.uint16), kind="stable")
    tokens, begun = np.unique(padded[order], return_index=True)
    grad.embed[tokens] = np.add.reduceat(returned[order], begun, 0)
    grad.flat /= len(at)
    squares.flat += grad.flat**2
    network.flat -= rate * grad.flat / np.sqrt(squares.flat + 1e-8)
    return len(at)


def vocabulary(documents: DataFrame, text: str = "text", size: int = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the ``size`` most frequent words (ties by hash), and their numbers from 1."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [h for _, _, _, h, _ in _word_runs(batch.column(0))]
            words, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *hashes]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "n"])

    counts = documents.select(F.col(text).alias("t")).mapInArrow(count, "word long, n long")
    total = counts.groupBy("word").agg(F.sum("n").alias("n"))
    top = total.orderBy(F.desc("n"), "word").limit(size).collect()
    hashes = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], order + 1


def _summed(copies: DataFrame, parts: int) -> DataFrame:
    """One row of arrays added up: ``parts`` partitions become fewer by ``FAN`` at a time."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for k in range(batch.num_rows):
                some = np.frombuffer(batch.column(0)[k].as_py(), np.float64)
                total = some.copy() if total is None else np.add(total, some, out=total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

    while parts > 1:
        parts = -(-parts // FAN)
        copies = copies.repartition(parts).mapInArrow(add, "sums binary")
    return copies


def train(documents: DataFrame, text: str = "text", rounds: int = ROUNDS, rate: float = 0.2, size: int = VOCABULARY) -> Model:
    spark = documents.sparkSession
    model = blank_model()
    model.hashes, model.numbers = vocabulary(documents, text, min(size, VOCABULARY))
    pairs = np.zeros(1 << 16)
    column = documents.select(F.col(text).alias("t"))
    for number in range(rounds):
        shared = spark.sparkContext.broadcast((model.hashes, model.numbers, model.network.flat))

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, numbers, flat = shared.value
            mine, squares = Network(flat.copy()), Network(np.zeros_like(flat))
            known = Model(hashes, numbers, mine, np.empty(0))
            used, pairs = 0, np.zeros(1 << 16)
            turn = TaskContext.get().partitionId()  # else single-run partitions would all have the same round
            for batch in batches:
                for padded, _, (data, begin, end) in padded_runs(known, batch.column(0)):
                    turn += 1
                    if turn % rounds != number:
                        continue
                    for low in range(0, len(padded) - 2 * SPAN, STEP):
                        used += train_step(mine, squares, padded[low : low + STEP + 2 * SPAN], rate)
                    rare = padded[padded != END] >= CLASSES * MEMBERS
                    if rare.any():
                        pairs += pair_counts(data, begin[rare], end[rare])
            if used:
                sums = np.concatenate([[used], pairs, mine.flat.astype(np.float64) * used])
                yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()])], ["sums"])

        copies = column.mapInArrow(local, "sums binary")
        row = _summed(copies, copies.rdd.getNumPartitions()).first()
        if row:
            sums = np.frombuffer(row["sums"], np.float64)
            pairs += sums[1 : 1 + (1 << 16)]
            model.network = Network((sums[1 + (1 << 16):] / sums[0]).astype(np.float32))
    table = pairs.reshape(256, 256) + 0.01
    model.spelling = np.log(table / table.sum(1, keepdims=True))
    return model


def scored(documents: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with n_tokens and log_prob, the summed conditional log-probabilities."""
    shared = documents.sparkSession.sparkContext.broadcast(
        (model.hashes, model.numbers, model.network.flat, model.spelling))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, numbers, flat, spelling = shared.value
        model = Model(hashes, numbers, Network(flat), spelling)
        for batch in batches:
            counts, sums = [np.empty(0, np.int64)], [np.empty(0)]
            for padded, first, (data, begin, end) in padded_runs(model, batch.column(1)):
                at = positions_of(padded)
                each = log_probabilities(model.network, padded)
                rare = padded[at] >= CLASSES * MEMBERS
                each[rare] += spelled(model, data, begin[rare], end[rare])
                total = np.concatenate([[0], np.cumsum(each)])
                bounds = np.searchsorted(at, first)
                counts.append(np.diff(bounds))
                sums.append(total[bounds[1:]] - total[bounds[:-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(counts)), pa.array(np.concatenate(sums))],
                ["kept", "n_tokens", "log_prob"])

    pairs = documents.select(F.struct(*keep).alias("kept"), F.col(text).alias("t"))
    schema = pairs.select("kept", F.lit(0).cast("long").alias("n_tokens"), F.lit(0.0).alias("log_prob")).schema
    return pairs.mapInArrow(run, schema).select("kept.*", "n_tokens", "log_prob")
