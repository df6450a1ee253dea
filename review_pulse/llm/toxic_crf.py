"""Toxicity: a linear-chain conditional random field over words, fitted and run in numpy.

Documents are labelled, words are not; words get labels first: in documents marked toxic, a word is
labelled when it, or a stem that it begins with, is far more frequent in toxic documents than in others. One half of the
sample fits the field, the other half what makes a score of its marginals; near copies mostly stay in one half. The field has two
tags, weights for the hashed word, its stems (first bytes), the word before and the one after, and
transition weights. Its exact marginals (forward-backward over whole texts, in blocks of words side by side)
give offending spans, and, through two numbers per document, the document's score.

Defined results: NULL, empty or wordless texts get the score of a text without any marginal; if the
sample lacks one of the labels, every text gets the labels' prior; repeated rows score alike.
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

BUCKETS = 1 << 20
NEARBY = 1 << 14  # buckets of the words before and after
STEMS = 1 << 18
STEM_BYTES = (4, 5)
BLOCK = 64
MIN_LIFT = 3.0  # log of how much more frequent in toxic documents
MIN_SHARE = 0.02  # of the toxic documents of the sample
SPAN_AT = 0.5
RATE = 1.0


@dataclass
class Model:
    word: np.ndarray
    before: np.ndarray
    after: np.ndarray
    stems: np.ndarray
    bias: float
    chain: np.ndarray  # transition weights, exponentiated: from tag, to tag
    total: np.ndarray  # intercept and weights of the two numbers of a document


def words_of(data: np.ndarray, starts: np.ndarray, low: int, high: int) -> tuple[np.ndarray, ...]:
    """Hashed words of the texts low..high, their spans in bytes, and each text's first word."""
    some = bytewise.LOWER[data[starts[low] : starts[high]]]
    begin, end, first = bytewise.spans(some, starts[low : high + 1] - starts[low], bytewise.IS_LETTER)
    ids = (bytewise.hash_spans(some, begin, end) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
    return ids, begin, end, first, stems_of(some, begin, end)


def stems_of(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashed first bytes of each word, one row per length; 0 for shorter words."""
    out = np.zeros((len(STEM_BYTES), len(begin)), np.int64)
    for row, size in zip(out, STEM_BYTES):
        long = end - begin > size
        hashed = bytewise.hash_spans(data, begin[long], begin[long] + size)
        row[long] = (hashed % np.uint64(STEMS - 1)).astype(np.int64) + 1
    return out


def neighbours(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before and the word after each, 0 at the ends of a text."""
    before, after = np.zeros_like(ids), np.zeros_like(ids)
    before[1:], after[:-1] = ids[:-1], ids[1:]
    begins = first[:-1][first[:-1] < first[1:]]
    before %= NEARBY
    after %= NEARBY
    before[begins] = 0
    after[first[1:][first[:-1] < first[1:]] - 1] = 0
    return before, after


def forward_backward(score: np.ndarray, first: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of tag 1 at each word, and expected transitions, of chains that begin in tag 0.

    Each chain is cut into blocks. The product of a block's transfer matrices carries the messages
    from block to block; inside, all blocks run side by side.
    """
    lengths = np.diff(first)
    blocks = -(-lengths // BLOCK)
    block_first = np.concatenate([[0], np.cumsum(blocks)])
    count = int(block_first[-1])
    expected = np.zeros((2, 2))
    if not count:
        return np.zeros(0), expected
    inside = np.arange(len(score)) - np.repeat(first[:-1], lengths)
    row, column = np.repeat(block_first[:-1], lengths) + inside // BLOCK, inside % BLOCK
    weight, real = np.ones((BLOCK, count)), np.zeros((BLOCK, count), bool)
    weight[column, row] = np.exp(np.clip(score, -30, 30))
    real[column, row] = True
    width = int(column.max()) + 1
    (a00, a01), (a10, a11) = chain

    product = np.zeros((2, 2, count))
    product[0, 0] = product[1, 1] = 1
    for t in range(width):
        zero, one = product[:, 0] * a00 + product[:, 1] * a10, (product[:, 0] * a01 + product[:, 1] * a11) * weight[t]
        size = (zero + one).sum(0)
        product = np.where(real[t], np.stack([zero, one], 1) / size, product)
    enter, leave = np.zeros((2, count)), np.ones((2, count))
    for k in range(int(blocks.max())):
        docs = np.flatnonzero(blocks > k)
        at = block_first[docs] + k
        if k == 0:
            enter[0, at] = 1
        else:
            got = (enter[:, None, at - 1] * product[:, :, at - 1]).sum(0)
            enter[:, at] = got / got.sum(0)
        last = block_first[docs + 1] - 1 - k
        if k:
            got = (product[:, :, last + 1] * leave[None, :, last + 1]).sum(1)
            leave[:, last] = got / got.sum(0)
    forward = np.empty((width, 2, count))
    state = enter
    for t in range(width):
        zero, one = state[0] * a00 + state[1] * a10, (state[0] * a01 + state[1] * a11) * weight[t]
        size = zero + one
        state = np.where(real[t], np.stack([zero / size, one / size]), state)
        forward[t] = state
    marginal = np.zeros((BLOCK, count))
    state = leave
    for t in range(width - 1, -1, -1):
        joint = forward[t] * state
        marginal[t] = joint[1] / joint.sum(0)
        past = forward[t - 1] if t else enter
        ahead = np.stack([state[0], state[1] * weight[t]])
        pair = past[:, None] * chain[:, :, None] * ahead[None]
        expected += (pair / pair.sum((0, 1)))[:, :, real[t]].sum(2)
        back = np.stack([a00 * ahead[0] + a01 * ahead[1], a10 * ahead[0] + a11 * ahead[1]])
        state = np.where(real[t], back / back.sum(0), state)
    return marginal[column, row], expected


def _two_numbers(marginal: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each document 1, the log of the summed marginals, and the largest marginal."""
    out = np.zeros((len(first) - 1, 3))
    out[:, 0] = 1
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full, 1] = np.add.reduceat(marginal, first[full])
        out[full, 2] = np.maximum.reduceat(marginal, first[full])
    out[:, 1] = np.log(out[:, 1] + 0.01)
    return out


def halves(column: pa.Array) -> np.ndarray:
    """The half, 0 or 1, of each text, by the least hash of its runs of four words: near copies mostly share it.

    A run that names more than one text in sixteen is common, not a copy: those texts alternate.
    """
    data, starts = bytewise.utf8(column)
    own = bytewise.mixed(np.arange(len(column)).astype(np.uint64))
    keys = own.copy()
    for low, high in bytewise.groups(starts):
        ids, _, _, first, _ = words_of(data, starts, low, high)
        runs = ids.astype(np.uint64)
        for k in range(1, 4):
            runs = bytewise.mixed(runs * np.uint64(31) + np.roll(ids, -k).astype(np.uint64))
        full = np.flatnonzero(np.diff(first))
        if len(full):
            keys[low + full] = np.minimum.reduceat(runs, first[full])
    _, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    keys = np.where(count[place] * 16 > len(keys), own, keys)
    return np.unique(keys, return_inverse=True)[1] % 2


def fit_total(numbers: np.ndarray, y: np.ndarray, start: np.ndarray, penalty: float = 0.05) -> np.ndarray:
    """Weights of a small penalised logistic regression: Newton steps, halved until the likelihood rises."""
    def likelihood(weights: np.ndarray) -> float:
        score = numbers @ weights
        return float(score @ y - np.logaddexp(0, score).sum() - 0.5 * penalty * weights @ weights)

    weights, now = start.copy(), likelihood(start)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(numbers @ weights, -30, 30)))
        hessian = (numbers * (p * (1 - p))[:, None]).T @ numbers + penalty * np.eye(len(weights))
        step = np.linalg.solve(hessian, numbers.T @ (y - p) - penalty * weights)
        while (then := likelihood(weights + step)) <= now and np.abs(step).max() > 1e-9:
            step = step / 2
        if then <= now:
            break
        weights, now = weights + step, then
    return weights


def fit(sample: Sample, rounds: int = 30) -> Model:
    y = sample.labels
    model = Model(np.zeros(BUCKETS, np.float32), np.zeros(NEARBY, np.float32), np.zeros(NEARBY, np.float32),
                  np.zeros(STEMS, np.float32), -4.0, np.ones((2, 2)), np.zeros(3))
    model.total[0] = sample.prior
    column = pa.array(sample.texts, pa.string())
    half = halves(column)
    if any(len(set(y[half == k])) < 2 for k in (0, 1)):
        return model
    fit_chain(model, column.filter(pa.array(half == 0)), y[half == 0], rounds)
    column, y = column.filter(pa.array(half == 1)), y[half == 1]
    data, starts = bytewise.utf8(column)
    numbers = np.concatenate([chain_numbers(model, data, starts, a, b)[0] for a, b in bytewise.groups(starts)])
    model.total[:] = fit_total(numbers, y, model.total)
    model.total[0] += sample.shift
    return model


def offending(ids: np.ndarray, owner: np.ndarray, y: np.ndarray, buckets: int) -> np.ndarray:
    """The buckets that are far more frequent in toxic documents."""
    seen = np.unique(owner * buckets + ids)
    toxic_owner = y[seen // buckets] == 1
    toxic = np.bincount(seen[toxic_owner] % buckets, minlength=buckets)
    clean = np.bincount(seen[~toxic_owner] % buckets, minlength=buckets)
    lift = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((clean + 0.5) / ((1 - y).sum() + 1))
    return (lift > MIN_LIFT) & (toxic >= np.maximum(4, MIN_SHARE * y.sum()))


def fit_chain(model: Model, column: pa.Array, y: np.ndarray, rounds: int) -> None:
    """Label words, then climb the penalised likelihood of the tags by AdaGrad."""
    data, starts = bytewise.utf8(column)
    ids, _, _, first, stems = words_of(data, starts, 0, len(column))
    owner = np.repeat(np.arange(len(y)), np.diff(first))
    hot = offending(ids, owner, y, BUCKETS)[ids]
    for row in stems:
        hot |= offending(row, owner, y, STEMS)[row] & (row > 0)
    tags = (hot & (y[owner] == 1)).astype(float)
    observed = np.zeros((2, 2))
    before_tags = np.concatenate([[0], tags[:-1]])
    before_tags[first[:-1][np.diff(first) > 0]] = 0
    np.add.at(observed, (before_tags.astype(int), tags.astype(int)), 1)

    before, after = neighbours(ids, first)
    words, ranked = np.unique(ids, return_inverse=True)
    tables = [(np.zeros(len(words)), ranked), (np.zeros(NEARBY), before), (np.zeros(NEARBY), after)]
    shared = np.zeros(STEMS)
    tables += [(shared, row) for row in stems]
    squares = [np.full(len(w), 1e-8) for w, _ in tables]
    penalties = (0.3, 1.0, 1.0, 0.1, 0.1)
    transition, transition_squares, bias_square = np.zeros((2, 2)), np.full((2, 2), 1e-8), 1e-8
    for _ in range(rounds):
        score = sum(w[p] for w, p in tables) + model.bias
        marginal, expected = forward_backward(score, first, np.exp(transition))
        error = tags - marginal
        for (w, place), square, penalty in zip(tables, squares, penalties):
            step = np.bincount(place, error, len(w)) - penalty * w
            square += step**2
            w += RATE * step / np.sqrt(square)
        shared[0] = 0
        step = observed - expected - 0.1 * transition
        step[0, 0] = 0
        transition_squares += step**2
        transition += RATE * step / np.sqrt(transition_squares)
        bias_square += error.sum() ** 2
        model.bias += RATE * error.sum() / np.sqrt(bias_square)
    model.word[words] = tables[0][0]
    model.before[:], model.after[:] = tables[1][0], tables[2][0]
    model.stems[:] = shared
    model.stems[0] = 0
    model.chain = np.exp(transition)


def chain_numbers(model: Model, data: np.ndarray, starts: np.ndarray, low: int, high: int) -> tuple[np.ndarray, ...]:
    """The two numbers of the texts low..high, the marginals of their words, and the words' places."""
    ids, begin, end, first, stems = words_of(data, starts, low, high)
    before, after = neighbours(ids, first)
    score = model.word[ids].astype(float) + model.before[before] + model.after[after] + model.bias
    score += model.stems[stems].sum(0)
    marginal, _ = forward_backward(score, first, model.chain)
    return _two_numbers(marginal, first), marginal, begin, end, first


def tagged(model: Model, column: pa.Array, spans: bool) -> tuple[np.ndarray, list]:
    """Score of each text and, if asked for, its offending spans in code points with their marginals."""
    data, starts = bytewise.utf8(column)
    scores, found = [np.empty(0)], []
    for low, high in bytewise.groups(starts):
        numbers, marginal, begin, end, first = chain_numbers(model, data, starts, low, high)
        scores.append(1 / (1 + np.exp(-np.clip(numbers @ model.total, -30, 30))))
        if spans:
            chars = np.concatenate([[0], np.cumsum((data[starts[low] : starts[high]] & 0xC0) != 0x80)])
            for k in range(high - low):
                hot = first[k] + np.flatnonzero(marginal[first[k] : first[k + 1]] >= SPAN_AT)
                base = chars[starts[low + k] - starts[low]]
                found.append([{"start": int(chars[begin[i]] - base), "end": int(chars[end[i]] - base),
                               "p": float(marginal[i])} for i in hot])
    return np.concatenate(scores), found


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))


def scored(documents: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` with ``score`` and the offending ``spans`` of the whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(astuple(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            scores, found = tagged(model, batch.column(1), True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array(found, _SPANS)], ["kept", "score", "spans"])

    pairs = documents.select(F.struct(*keep).alias("kept"), F.col(text).alias("t"))
    span = F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"), F.lit(0.0).alias("p"))
    schema = pairs.select("kept", F.lit(0.0).alias("score"), F.array(span).alias("spans")).schema
    return pairs.mapInArrow(run, schema).select("kept.*", "score", "spans")
