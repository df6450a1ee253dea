"""Byte-level BPE: encoding by ranked merges and decoding by concatenated pieces.

Within a task, a run of whole texts is split by the tokenizer's pattern. The ranked merges are
folded over the byte arrays of its distinct new pieces only, all pieces of about one length side by
side in numpy, with a table of the rank of every pair of tokens; the ids then go back to the
documents by place. Decoding concatenates the byte strings of the ids. Nothing is shuffled; a run
holds about ``RUN`` characters or one document, and a task remembers about ``KNOWN`` pieces.

The fold moves a whole row with every merge, so its work grows with the square of a piece; pieces
above the last of ``WIDTHS`` bytes (runs without a space) are merged with a heap, with the same result.

The rank file is read once by the driver; its path is a parameter, and the pair table that is
broadcast is bounded by its size. Defined results: NULL text is an empty one, of no tokens, and
decodes to no bytes; repeated rows encode alike; special-token strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN = 1 << 20
KNOWN = 1 << 17  # distinct pieces that a task remembers
WIDTHS = (8, 16, 32, 64, 128)
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the single bytes; every pair of tokens that makes a token, sorted, and its rank."""
    found = []
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            left, right = ranks.get(token[:k]), ranks.get(token[k:])
            if left is not None and right is not None:
                found.append((left << 32 | right, rank))
    table = np.array(sorted(found), np.int64).reshape(-1, 2)
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    return single, table[:, 0].copy(), table[:, 1].astype(np.int32)


def _pair_ranks(table: tuple, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    _, keys, values = table
    key = left.astype(np.int64) << 32 | right
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where((keys[at] == key) & (left >= 0) & (right >= 0), values[at], NONE)


def _fold(table: tuple, parts: np.ndarray) -> np.ndarray:
    """Rows of byte ids, -1 after the end: merged lowest rank first, leftmost first among equals."""
    done = parts.copy()
    rows = np.arange(len(parts))
    ranks = _pair_ranks(table, parts[:, :-1], parts[:, 1:])
    columns = np.arange(parts.shape[1])
    while True:
        best = ranks.min(1)
        going = best < NONE
        if not going.all():
            done[rows[~going]] = parts[~going]
            rows, parts, ranks, best = rows[going], parts[going], ranks[going], best[going]
        if not len(rows):
            return done
        at = ranks.argmin(1)
        own = np.arange(len(rows))
        beyond = columns > at[:, None]
        moved = np.take_along_axis(parts, np.minimum(columns + beyond, len(columns) - 1), 1)
        moved[:, -1] = -1
        moved[own, at] = best
        ranks = np.take_along_axis(ranks, np.minimum(columns[:-1] + beyond[:, :-1], len(columns) - 2), 1)
        ranks[:, -1] = NONE
        after = np.minimum(at + 1, len(columns) - 1)
        ranks[own, np.minimum(at, len(columns) - 2)] = np.where(
            at < len(columns) - 1, _pair_ranks(table, moved[own, at], moved[own, after]), NONE)
        before = np.maximum(at - 1, 0)
        ranks[own, before] = np.where(
            at > 0, _pair_ranks(table, moved[own, before], moved[own, at]), ranks[own, before])
        parts = moved


def heap_fold(single: np.ndarray, pairs: dict[int, int], piece: bytes) -> list[int]:
    """The same ids for one long piece, with a heap of mergeable neighbours."""
    parts = single[np.frombuffer(piece, np.uint8)].tolist()
    following, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = following[i]
        if j < len(parts) and (rank := pairs.get(parts[i] << 32 | parts[j])) is not None:
            heapq.heappush(heap, (rank, i, parts[i], parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = following[i]
        if parts[i] != left or j >= len(parts) or parts[j] != right:
            continue
        parts[i], parts[j] = rank, -1
        following[i] = following[j]
        if following[i] < len(parts):
            before[following[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p >= 0]


def fold_pieces(table: tuple, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, one after another, and the place where each piece's begin (one more at the end)."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    data = table[0][np.frombuffer(b"".join(pieces), np.uint8)]
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    counts = np.zeros(len(pieces), np.int64)
    low = 0
    for width in WIDTHS:
        chosen = np.flatnonzero((lengths > low) & (lengths <= width))
        low = width
        for some in np.array_split(chosen, 1 + len(chosen) * width // (1 << 20)):
            inside = np.arange(width) < lengths[some][:, None]
            parts = np.full((len(some), width), -1, np.int32)
            parts[inside] = data[np.repeat(starts[some], lengths[some]) + np.nonzero(inside)[1]]
            parts = _fold(table, parts)
            counts[some] = (parts >= 0).sum(1)
            rows.append((some, parts[parts >= 0]))
    longer = np.flatnonzero(lengths > low)
    pairs = dict(zip(table[1].tolist(), table[2].tolist())) if len(longer) else {}
    for k in longer:
        ids = np.array(heap_fold(table[0], pairs, pieces[k]), np.int32)
        counts[k] = len(ids)
        rows.append((np.array([k]), ids))
    ends = np.concatenate([[0], np.cumsum(counts)])
    flat = np.empty(ends[-1], np.int32)
    for some, ids in rows:
        flat[_places(ends[some], counts[some])] = ids
    return flat, ends


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its count says."""
    begun = np.cumsum(counts) - counts
    return np.repeat(starts - begun, counts) + np.arange(int(counts.sum()))


def _runs(table: tuple, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Runs of documents: their kept columns, the numbers of each one's pieces, and all pieces' ids.

    The ids of piece k are ``flat[ends[k]:ends[k + 1]]``; the last result is the first new piece. Pieces stay known from run to run until there
    are ``KNOWN`` of them, so a piece is folded about once per task.
    """
    import regex

    matcher = regex.compile(pattern)
    index: dict[str, int] = {}
    flat, ends = np.empty(0, np.int32), np.zeros(1, np.int64)
    kept, places, size = [], [], 0

    def folded() -> tuple:
        nonlocal flat, ends
        first = len(ends) - 1
        new = list(itertools.islice(index, first, None))
        ids, more = fold_pieces(table, [p.encode("utf-8", "surrogatepass") for p in new])
        flat, ends = np.concatenate([flat, ids]), np.concatenate([ends, ends[-1] + more[1:]])
        return pa.concat_arrays(kept), places, flat, ends, first

    for batch in batches:
        low = 0
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_py() or ""
            pieces = matcher.findall(text) if len(text) <= RUN else (m[0] for m in matcher.finditer(text))
            places.append(np.fromiter((index.setdefault(p, len(index)) for p in pieces), np.int32))
            size += len(text)
            if size >= RUN:
                kept.append(batch.column(0).slice(low, i + 1 - low))
                yield folded()
                kept, places, size, low = [], [], 0, i + 1
                if len(index) >= KNOWN:
                    index.clear()
                    flat, ends = np.empty(0, np.int32), np.zeros(1, np.int64)
        if low < batch.num_rows:
            kept.append(batch.column(0).slice(low))
    if kept:
        yield folded()


def _encoded(table: tuple, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, places, flat, starts, _ in _runs(table, pattern, batches):
        counts = np.diff(starts)
        own = np.concatenate(places)
        ids = flat[_places(starts[own], counts[own])]
        sums = np.concatenate([[0], np.cumsum(counts[own])])
        ends = sums[np.concatenate([[0], np.cumsum([len(p) for p in places])])]
        listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))
        yield pa.RecordBatch.from_arrays([rows, listed], ["kept", "ids"])


def encode(documents: DataFrame, ranks: dict[bytes, int], pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``ids``, the token ids of the whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(pair_table(ranks))
    pairs = documents.select(F.struct(*keep).alias("kept"), F.col(text).alias("t"))
    schema = pairs.select("kept", F.array(F.lit(0)).alias("ids")).schema
    return pairs.mapInArrow(lambda batches: _encoded(shared.value, pattern, batches), schema).select("kept.*", "ids")


def decoded(tokens: list[bytes], ids: np.ndarray) -> Iterator[bytes]:
    """The bytes of the ids' tokens, concatenated, some thousands of ids at a time."""
    for low in range(0, len(ids), 1 << 16):
        yield b"".join(map(tokens.__getitem__, ids[low : low + (1 << 16)].tolist()))


def _token_list(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (1 + max(ranks.values(), default=-1))
    for token, rank in ranks.items():
        out[rank] = token
    return out


def decode(encodings: DataFrame, ranks: dict[bytes, int], keep: list[str]) -> DataFrame:
    """Columns ``keep`` and ``decoded``, the bytes of ``ids``; NULL ids decode to no bytes."""
    shared = encodings.sparkSession.sparkContext.broadcast(_token_list(ranks))
    pairs = encodings.select(F.struct(*keep).alias("kept"), "ids")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [b"".join(decoded(shared.value, own.values.to_numpy())) if own.is_valid and len(own.values) else b""
                   for own in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["kept", "decoded"])

    schema = pairs.select("kept", F.lit(b"").alias("decoded")).schema
    return pairs.mapInArrow(joined, schema).select("kept.*", "decoded")


def digests(documents: DataFrame, ranks: dict[bytes, int], pattern: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with the number of tokens and digests of the ids and of the decoded bytes.

    One pass encodes, decodes and hashes: neither ids nor bytes of more than a run are ever held, and
    every piece is decoded once from its ids.
    """
    shared = documents.sparkSession.sparkContext.broadcast((pair_table(ranks), _token_list(ranks)))
    pairs = documents.select(F.struct(*keep).alias("kept"), F.col("text").alias("t"))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, tokens = shared.value
        known: list[bytes] = []
        for rows, places, flat, starts, first in _runs(table, pattern, batches):
            del known[first:]
            known += [b"".join(decoded(tokens, flat[starts[k]:starts[k + 1]])) for k in range(len(known), len(starts) - 1)]
            counts = np.diff(starts)
            out: list[list] = [[], [], []]
            for own in places:
                ids, content = hashlib.sha256(), hashlib.sha256()
                for low in range(0, len(own), 1 << 16):
                    some = own[low : low + (1 << 16)]
                    ids.update(flat[_places(starts[some], counts[some])].astype("<u4").tobytes())
                    content.update(b"".join(map(known.__getitem__, some.tolist())))
                for column, value in zip(out, (int(counts[own].sum()), ids.hexdigest(), content.hexdigest())):
                    column.append(value)
            columns = [pa.array(values, kind) for values, kind in zip(out, (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([rows, *columns], ["kept", *names])

    kinds = [F.lit(0).cast("long"), F.lit(""), F.lit("")]
    schema = pairs.select("kept", *[k.alias(n) for k, n in zip(kinds, names)]).schema
    return pairs.mapInArrow(hashed, schema).select("kept.*", *names)
