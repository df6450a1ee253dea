"""Ranked lexical search: Block-Max MaxScore over shards of compressed postings.

``index`` turns every run of texts into a shard, one row: its terms, and for each term the documents that
hold it and how often, in blocks of ``BLOCK`` postings packed into one, two or four bytes a number. A
block's header has its largest frequency and the least length of its documents, which bound
every score in it whatever the collection's statistics turn out to be; those are summed from the stored index.

``search`` reads the shards one after another and holds, for every query, the best documents so far.
A list's global bound is the largest of its blocks. With the lists sorted by bound, those whose bounds
together stay below the worst of the best are not essential: a document found in them alone cannot
qualify. Only the other lists give candidates. Each remaining list, largest bound first, then first rejects
candidates by the bounds of all lists to come, next by the maximum of the block that would hold them,
and only the blocks of candidates that are left are unpacked. What a task holds in the end, at most
``k`` rows for a query, is merged by a ranking window, which Spark limits before the exchange.

Queries are cut into blocks of about ``MAX_QUERY_CHARS`` characters by a hash of their texts; a block
is what the driver reads and broadcasts, and one more pass over the stored index.

Defined results: NULL or termless texts are in no list; a query without terms, or without a
document that shares one, has no rows; documents without an id are ranked, last among equals; every
row of a query's id is a query of its own, and repeated documents are ranked one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from review_pulse.llm.shared import remove, stored

TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
BLOCK = 128
RUN = 1 << 22  # characters of the texts of a shard
ROW_GROUP = 1 << 24  # bytes; Spark reads a row group's shards at once
MAX_QUERY_CHARS = 1_000_000
WIDTHS = ("<u1", "<u2", "<u4")
SHARD = ("ids binary, no_id binary, lengths binary, terms string, df binary, first binary, widths binary, "
         "top_tf binary, least_length binary, data binary")


def terms_of(text: str | None) -> list[str]:
    return re.findall(TERMS, (text or "").encode().translate(LOWER).decode())


def width_class(largest: np.ndarray) -> np.ndarray:
    return (largest > 0xFF).astype(np.uint8) + (largest > 0xFFFF)


def pack(values: np.ndarray, starts: np.ndarray, classes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Values of the blocks that begin at ``starts``, packed as wide as their class says, and each block's first byte."""
    counts = np.diff(np.append(starts, len(values)))
    sizes = counts << classes
    offsets = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    each = np.repeat(classes, counts)
    at = np.repeat(offsets, counts) + ((np.arange(len(values)) - np.repeat(starts, counts)) << each)
    for c, kind in enumerate(WIDTHS):
        some = each == c
        size = 1 << c
        out[at[some][:, None] + np.arange(size)] = values[some].astype(kind)[:, None].view(np.uint8).reshape(-1, size)
    return out.tobytes(), offsets


def shard_row(ids: list[int | None], counted: list[np.ndarray], terms: dict[str, int]) -> dict[str, bytes | str]:
    """The shard of some documents; ``counted`` has the term number of each word of each document."""
    lengths = np.array([len(x) for x in counted], np.int64)
    doc = np.repeat(np.arange(len(ids)), lengths)
    key = np.concatenate([*counted, np.empty(0, np.int64)]).astype(np.int64) * max(len(ids), 1) + doc
    key.sort()
    begin = np.flatnonzero(np.diff(key, prepend=-1))
    tf = np.diff(np.append(begin, len(key)))
    term, doc = np.divmod(key[begin], max(len(ids), 1))
    df = np.bincount(term, minlength=len(terms))
    list_starts = np.cumsum(df) - df
    inside = np.arange(len(term)) - list_starts[term]
    starts = np.flatnonzero(inside % BLOCK == 0)
    least = lambda x: np.minimum.reduceat(x, starts) if len(starts) else np.empty(0, np.int64)
    first, top_tf, least_length = doc[starts], -least(-tf), least(lengths[doc])
    ahead = doc - np.repeat(first, np.diff(np.append(starts, len(doc))))
    doc_class, tf_class = width_class(-least(-ahead)), width_class(top_tf)
    doc_bytes, doc_at = pack(ahead, starts, doc_class)
    tf_bytes, _ = pack(tf, starts, tf_class)
    raw = lambda x, kind: x.astype(kind).tobytes()
    return {
        "ids": raw(np.array([i or 0 for i in ids], np.int64), "<i8"), "no_id": raw(np.array([i is None for i in ids]), "u1"),
        "lengths": raw(lengths, "<i8"), "terms": " ".join(terms), "df": raw(df, "<u4"), "first": raw(first, "<u4"),
        "widths": raw(doc_class | tf_class << 2, "u1"), "top_tf": raw(top_tf, "<u4"),
        "least_length": raw(least_length, "<u4"), "data": len(doc_bytes).to_bytes(8, "little") + doc_bytes + tf_bytes,
    }


def index(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each shard of the documents, with all terms of their whole texts."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(TERMS)
        ids, counted, terms, size = [], [], {}, 0
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = (text or "").encode().translate(LOWER).decode()
                found = pattern.findall(text) if len(text) <= RUN else (m[0] for m in pattern.finditer(text))
                ids.append(own)
                counted.append(np.fromiter((terms.setdefault(t, len(terms)) for t in found), np.int64))
                size += len(text)
                if size >= RUN:
                    yield pa.RecordBatch.from_pylist([shard_row(ids, counted, terms)])
                    ids, counted, terms, size = [], [], {}, 0
        if ids:
            yield pa.RecordBatch.from_pylist([shard_row(ids, counted, terms)])

    return documents.select(F.col(doc_id).cast("long"), F.col(text).alias("t")).mapInArrow(build, SHARD)


class Shard:
    """The lists of a shard, unpacked block by block as they are asked for."""

    def __init__(self, row: dict) -> None:
        read = lambda name, kind: np.frombuffer(row[name], kind).astype(np.int64)
        self.ids, self.no_id, self.lengths = read("ids", "<i8"), read("no_id", "u1"), read("lengths", "<i8")
        self.df, self.first, widths = read("df", "<u4"), read("first", "<u4"), read("widths", "u1")
        self.top_tf, self.least_length = read("top_tf", "<u4"), read("least_length", "<u4")
        self.doc_class, self.tf_class = widths & 3, widths >> 2
        names = row["terms"].split(" ") if row["terms"] else []
        self.place = dict(zip(names, range(len(names))))
        blocks = -(-self.df // BLOCK)
        self.begin = np.concatenate([[0], np.cumsum(blocks)])
        last = self.begin[1:][self.df > 0] - 1
        self.count = np.full(len(self.first), BLOCK)
        self.count[last] = self.df[self.df > 0] - (blocks[self.df > 0] - 1) * BLOCK
        doc_sizes, tf_sizes = self.count << self.doc_class, self.count << self.tf_class
        self.doc_at = np.cumsum(doc_sizes) - doc_sizes + 8
        self.tf_at = np.cumsum(tf_sizes) - tf_sizes + 8 + int.from_bytes(row["data"][:8], "little")
        self.data, self.unpacked, self.opened = row["data"], {}, 0

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and frequencies of a block."""
        if b not in self.unpacked:
            self.opened += 1
            count = int(self.count[b])
            docs = np.frombuffer(self.data, WIDTHS[self.doc_class[b]], count, int(self.doc_at[b])) + self.first[b]
            tf = np.frombuffer(self.data, WIDTHS[self.tf_class[b]], count, int(self.tf_at[b]))
            self.unpacked[b] = docs.astype(np.int64), tf.astype(np.int64)
        return self.unpacked[b]


@dataclass
class Collection:
    """Documents with a term, all terms with repeats, and the weight of each term of the queries."""
    documents: int
    words: int
    weights: dict[str, int]

    def penalty(self, lengths: np.ndarray) -> np.ndarray:
        """A document's m. 75 * n * N div L without the whole product: n * (75 N div L) is split off."""
        whole, rest = divmod(75 * self.documents, max(self.words, 1))
        return 25 + lengths * whole + lengths * rest // max(self.words, 1)


def impact(tf: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * penalty)


@dataclass
class Best:
    """The best documents of a query so far, best first; ``least`` is what a newcomer has to reach."""
    score: np.ndarray
    no_id: np.ndarray
    ids: np.ndarray
    least: int = 1

    def add(self, score: np.ndarray, no_id: np.ndarray, ids: np.ndarray, k: int) -> None:
        score, no_id, ids = (np.concatenate(x) for x in ((self.score, score), (self.no_id, no_id), (self.ids, ids)))
        order = np.lexsort((ids, no_id, -score))[:k]
        self.score, self.no_id, self.ids = score[order], no_id[order], ids[order]
        self.least = max(1, int(self.score[-1])) if len(order) == k else 1


def scored_shard(shard: Shard, bounds: np.ndarray, penalty: np.ndarray, query: list[tuple[int, int]],
                 best: Best, k: int) -> None:
    """Offer the shard's documents to ``best``. ``query``: lists and the weight of their impacts."""
    lists = sorted(((weight * int(bounds[shard.begin[t]:shard.begin[t + 1]].max()), t, weight) for t, weight in query))
    total = np.cumsum([bound for bound, _, _ in lists])  # what the first lists can give together
    essential = int(np.searchsorted(total, best.least))
    if essential == len(lists):
        return
    beyond = int(total[essential - 1]) if essential else 0
    gained = np.zeros(len(shard.ids), np.int64)
    seen = np.zeros(len(shard.ids), bool)
    for _, t, weight in lists[essential:]:
        for b in range(shard.begin[t], shard.begin[t + 1]):
            docs, tf = shard.block(b)
            gained[docs] += weight * impact(tf, penalty[docs])
            seen[docs] = True
    candidates = np.flatnonzero(seen)
    partial = gained[candidates]
    for rank in range(essential - 1, -1, -1):
        alive = partial + beyond >= best.least
        candidates, partial = candidates[alive], partial[alive]
        if not len(candidates):
            return
        bound, t, weight = lists[rank]
        beyond -= bound
        low, high = int(shard.begin[t]), int(shard.begin[t + 1])
        holder = low + np.searchsorted(shard.first[low:high], candidates, "right") - 1
        most = np.where(holder >= low, weight * bounds[np.maximum(holder, low)], 0)
        alive = partial + most + beyond >= best.least
        candidates, partial, holder = candidates[alive], partial[alive], holder[alive]
        for b in np.unique(holder[holder >= low]):
            docs, tf = shard.block(int(b))
            own = np.flatnonzero(holder == b)
            at = np.minimum(np.searchsorted(docs, candidates[own]), len(docs) - 1)
            hit = docs[at] == candidates[own]
            rows, at = own[hit], at[hit]
            partial[rows] += weight * impact(tf[at], penalty[docs[at]])
    fits = partial >= best.least
    candidates, partial = candidates[fits], partial[fits]
    if len(candidates):
        best.add(partial, shard.no_id[candidates], shard.ids[candidates], k)


def _blocks(queries: DataFrame, query_id: str, text: str) -> Iterator[list[tuple[int | None, Counter]]]:
    chars = queries.agg(F.sum(F.length(text))).first()[0] or 0
    count = -(-chars // MAX_QUERY_CHARS) or 1
    rows = queries.select(F.col(query_id).alias("id"), F.col(text).alias("text"))
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("text", "id"), F.lit(count)) == k)
        yield [(r["id"], Counter(terms_of(r["text"]))) for r in part.collect()]


def collection(shards: DataFrame, terms: set[str]) -> Collection:
    """Sums over all shards: documents, words, and the number of documents of each of the terms."""
    shared = shards.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for lengths, names, df in zip(*(batch.column(k).to_pylist() for k in range(3))):
                lengths = np.frombuffer(lengths, "<i8")
                found[None] += int((lengths > 0).sum())
                found[""] += int(lengths.sum())
                for name, n in zip(names.split(" "), np.frombuffer(df, "<u4").tolist()):
                    if name in shared.value:
                        found[name] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["term", "n"])

    sums = shards.select("lengths", "terms", "df").mapInArrow(count, "term string, n long")
    n = {r["term"]: r["n"] for r in sums.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    documents = n.pop(None, 0)
    words = n.pop("", 0)
    weights = {t: int(1000 * np.log((2 * documents + 2) / (2 * df + 1))) for t, df in n.items()}
    return Collection(documents, words, weights)


def search(shards: DataFrame, queries: DataFrame, k: int = 10, query_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score``: each query's ``k`` best documents, if their score is above 0."""
    parts = [_search_block(shards, block, k) for block in _blocks(queries, query_id, text)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.col("item_id").alias(query_id), "rank", "doc_id", "score")


def _search_block(shards: DataFrame, queries: list[tuple[int | None, Counter]], k: int) -> DataFrame:
    statistics = collection(shards, {t for _, terms in queries for t in terms})
    shared = shards.sparkSession.sparkContext.broadcast((statistics, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        statistics, queries = shared.value
        none = np.empty(0, np.int64)
        held = [Best(none, none, none) for _ in queries]
        for batch in batches:
            for place in range(batch.num_rows):
                shard = Shard({name: batch.column(name)[place].as_py() for name in batch.schema.names})
                penalty = statistics.penalty(shard.lengths)
                bounds = impact(shard.top_tf, statistics.penalty(shard.least_length))
                for (_, terms), best in zip(queries, held):
                    lists = [(shard.place[t], n * statistics.weights[t]) for t, n in terms.items() if t in shard.place]
                    if lists:
                        scored_shard(shard, bounds, penalty, lists, best, k)
        columns = [np.repeat(np.arange(len(queries)), [len(b.ids) for b in held])]
        columns += [np.concatenate([none, *(getattr(b, name) for b in held)]) for name in ("ids", "score")]
        no_id = np.concatenate([none, *(b.no_id for b in held)]) > 0
        item = pa.array([queries[i][0] for i in columns[0].tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0]), item, pa.array(columns[1], mask=no_id), pa.array(columns[2])],
            ["query", "item_id", "doc_id", "score"])

    found = shards.mapInArrow(run, "query long, item_id long, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("query")


def ranked(documents: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``search`` over an index of the documents that is stored for it and removed afterwards."""
    shards = stored(index(documents), "lexical-index", {"parquet.block.size": ROW_GROUP})
    found = stored(search(shards, queries, k), "lexical-best")
    remove(shards)
    return found
