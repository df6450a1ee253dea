"""Exact top-k by inner product with the no-random-access algorithm over sorted lists.

Vectors become integers, floor(scale * component). For each dimension there is a list of candidates
sorted by value, read from the top for queries whose component is positive and from the bottom for
negative ones. After reading every list down to one depth, a candidate's lower bound takes the least
value of a list where it has not been met, its upper bound the list's frontier. Candidates whose
upper bound is below the k-th lower bound cannot qualify and are out. Reading goes on, twice as deep each
time, until few enough are left; only their scores are resolved. Where the bounds leave most
candidates, as for evenly spread vectors of many dimensions, the lists are read to their end, and
what has been read by then is every score.

Spark deals queries and candidates out in blocks of bounded size by a hash of their id, so that each
task sees one block of either; every block gives its own exact top k, and a window keeps the best of
each query. The work is that of a stated query set against all rows, in blocks.

Defined results: vectors that are NULL, or hold NULL or a non-finite component, or have no id, take
no part; shorter vectors count as padded with zeros; candidates with the query's own id are left out;
ties go to the smaller id; equal query rows count once, repeated candidate rows each; a query with
fewer than k candidates gets all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES = 8192  # rows of a block, about
QUERIES = 2048
TOGETHER = 256  # queries whose bounds are held at once
FIRST_DEPTH = 0.125  # share of every list that the first read covers
FEW = 0.125  # share of the candidates that may be left when scores are resolved one by one
HOPELESS = 0.9  # share of the candidates that, left after a read, sends it to the end of the lists


def integers(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """id and integer vector of the rows that take part."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col(vec_id).cast("long").alias("id"),
        F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def _exact_type(left: np.ndarray, right: np.ndarray):
    """The narrowest type in which all inner products and their partial sums are exact."""
    largest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(1, left.shape[1])
    return np.float32 if largest < 2**23 else np.float64 if largest < 2**52 else object


class SortedLists:
    """The candidates of a block, one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, kind) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order].astype(kind)
        self.order = np.argsort(-values[order], axis=0, kind="stable")
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(ids))[:, None], 0)
        self.sorted = np.take_along_axis(self.values, self.order, 0)
        self.resolved = 0  # scores worked out so far

    def read(self, depth: int) -> tuple[np.ndarray, ...]:
        """Upper and lower values, from the top for positive weights, from the bottom for negative ones."""
        count = len(self.ids)
        from_top, from_bottom = self.place < depth, self.place >= count - depth
        high, low = self.sorted[0], self.sorted[-1]
        return (np.where(from_top, self.values, self.sorted[depth - 1]), np.where(from_top, self.values, low),
                np.where(from_bottom, self.values, self.sorted[count - depth]), np.where(from_bottom, self.values, high))


def outsiders_out(lists: SortedLists, some: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Which candidates may still be among the k best of each query when reading stops."""
    count = len(lists.ids)
    positive, negative = np.maximum(some, 0), np.minimum(some, 0)
    left, depth = ~own, FIRST_DEPTH
    while depth < 1 and lists.values.dtype != object and count > k:
        top_upper, top_lower, bottom_upper, bottom_lower = lists.read(max(1, int(count * depth)))
        lower = positive @ top_lower.T + negative @ bottom_lower.T
        lower[own] = -np.inf
        least = np.partition(lower, count - k, axis=1)[:, count - k]
        left &= positive @ top_upper.T + negative @ bottom_upper.T >= least[:, None]
        if left.mean() <= FEW or left.mean() > HOPELESS:
            break
        depth *= 2
    return left


def block_top(lists: SortedLists, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(query, place, score) of the k best of the block for each query."""
    for low in range(0, len(queries), TOGETHER):
        some = queries[low : low + TOGETHER].astype(lists.values.dtype)
        left = outsiders_out(lists, some, lists.ids[None, :] == query_ids[low : low + TOGETHER, None], k)
        to_the_end = some @ lists.values.T if left.mean() > FEW else None
        for q in range(len(some)):
            places = np.flatnonzero(left[q])
            got = lists.values[places] @ some[q] if to_the_end is None else to_the_end[q, places]
            lists.resolved += len(places) if to_the_end is None else len(lists.ids)
            best = np.lexsort((places, -got))[:k] if len(places) <= 8 * k else _best(places, got, k)
            yield np.full(len(best), low + q), places[best], got[best]


def _best(places: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    some = np.flatnonzero(scores >= least)
    return some[np.lexsort((places[some], -scores[some]))[:k]]


def top_k(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
          scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id and score of the k best candidates of each row that ``queries`` selects."""
    candidates = integers(vectors, vec_id, embedding, scale)
    asked = integers(vectors.where(queries), vec_id, embedding, scale).distinct()
    some_candidates, some_queries = candidates.count(), asked.count()
    across, down = -(-some_candidates // CANDIDATES), -(-some_queries // QUERIES)

    def block(column: str, count: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(max(1, count))).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(max(1, count) - 1)))

    left = candidates.select("id", "v", block("id", across).alias("c"), every(down).alias("q"))
    right = asked.select("id", "v", block("id", down).alias("q"), every(across).alias("c"))

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        found = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if mine.num_rows and theirs.num_rows:
            lists, rows = mine.column("v").combine_chunks(), theirs.column("v").combine_chunks()
            width = max(1, *(int(np.diff(x.offsets.to_numpy()).max()) for x in (lists, rows)))
            values, weights = _matrix(mine.column("v"), width), _matrix(theirs.column("v"), width)
            ids = theirs.column("id").to_numpy()
            block = SortedLists(mine.column("id").to_numpy(), values, _exact_type(values, weights))
            for q, places, scores in block_top(block, ids, weights, k):
                for column, part in zip(found, (ids[q], block.ids[places], scores.astype(np.int64))):
                    column.append(part)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(np.concatenate(x)) for x in found))))

    parts = left.groupBy("q", "c").cogroup(right.groupBy("q", "c")).applyInArrow(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
