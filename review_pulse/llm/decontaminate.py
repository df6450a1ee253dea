"""Benchmark decontamination with suffix arrays of the training texts.

Every run of texts in a task is a shard: its words that the benchmark knows become numbers, all others
an end mark, and the places of the numbers are sorted by the words that follow (prefix doubling, as
deep as the longest item). All suffixes of all benchmark items are then binary-searched in the shard
side by side, one word deeper at a time, until nothing in the shard agrees any more. That gives each suffix's
longest verbatim match and its places; places where at least a window's words agree are hits.
Documents are neither shuffled nor joined; words are compared as strings, so matches are exact.

The benchmark is cut into blocks of about ``MAX_ITEM_CHARS`` characters by a hash of its items' texts;
a block is what the driver reads and broadcasts. With more than one block, the documents and what they
hit so far are written and read again between blocks.

Defined results: NULL or wordless texts have no words and no hits; items without words match nothing;
an item of fewer words than a window is one window; items that repeat an id count once, items without
an id hit words but are not listed; repeated documents are judged alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from review_pulse.llm.shared import stored

# A-Z are lower-cased before; every byte above 127 belongs to a word
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
WINDOW = 10
RUN = 1 << 21
MAX_ITEM_CHARS = 2_000_000
END = 0  # stands for every word that no item has, and for the end of a text


def words_of(text: str | None) -> list[str]:
    return re.findall(WORDS, (text or "").encode().translate(LOWER).decode())


@dataclass
class Suffixes:
    """The suffixes of a block's items: ``words[begin:]``, of which ``need`` words make a window."""
    vocabulary: dict[str, int]
    words: np.ndarray
    begin: np.ndarray
    need: np.ndarray
    length: np.ndarray
    item: np.ndarray  # the place in ``ids`` of each suffix's item
    ids: list[int | None]


def suffixes(items: list[tuple[int | None, str | None]], window: int) -> Suffixes:
    vocabulary: dict[str, int] = {}
    words, begin, need, length, item, ids = [], [], [], [], [], []
    for item_id, text in items:
        own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        least = min(window, len(own))
        for k in range(len(own) - least + 1 if own else 0):
            begin.append(len(words) + k)
            need.append(least)
            length.append(len(own) - k)
            item.append(len(ids))
        words += own
        ids.append(item_id)
    return Suffixes(vocabulary, *(np.array(x, np.int64) for x in (words, begin, need, length, item)), ids)


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Places of the words other than END, sorted by the next ``depth`` words; END sorts first and ends a suffix."""
    places = np.flatnonzero(words != END)
    rank = np.append(words, END)  # by one word, then two, four, ...
    compared, top = 1, int(words.max(initial=0)) + 1
    order = places[np.argsort(rank[places], kind="stable")]
    while compared < depth and len(places):
        follower = np.minimum(places + compared, len(words))
        key = rank[places] * top + rank[follower]
        sorted_at = np.argsort(key)
        order, key = places[sorted_at], key[sorted_at]
        new = np.ones(len(key), np.int64)
        new[1:] = key[1:] != key[:-1]
        ranks = np.cumsum(new)
        rank = np.full(len(words) + 1, END, np.int64)
        rank[order] = ranks
        top = int(ranks[-1]) + 1
        compared *= 2
        if ranks[-1] == len(places):
            break
    return order


def narrowed(words: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int,
             wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of each range low..high of the suffix array whose word at ``depth`` is the wanted one."""
    bounds = []
    for beyond in (False, True):
        left, right = low.copy(), high.copy()
        while (going := left < right).any():
            middle = (left + right) // 2
            found = words[np.minimum(order[np.minimum(middle, len(order) - 1)] + depth, len(words) - 1)]
            right_part = going & ((found <= wanted) if beyond else (found < wanted))
            left = np.where(right_part, middle + 1, left)
            right = np.where(going & ~right_part, middle, right)
        bounds.append(left)
    return bounds[0], bounds[1]


def longest_matches(words: np.ndarray, tests: Suffixes) -> tuple[np.ndarray, ...]:
    """For every place where a test suffix agrees for at least its window: suffix, place, words that agree.

    ``words`` ends in END. A place is given once for every suffix, with its own longest match.
    """
    order = suffix_array(words, int(tests.length.max(initial=1)))
    live = np.arange(len(tests.begin)) if len(order) else np.empty(0, np.int64)
    low, high = np.zeros(len(live), np.int64), np.full(len(live), len(order))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def ended(rows: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> None:
        """Places in low..high agree for just ``depth`` words."""
        enough = (tests.need[rows] <= depth) & (low < high)
        rows, low, count = rows[enough], low[enough], (high - low)[enough]
        at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        found.append((np.repeat(rows, count), order[at], np.full(len(at), depth)))

    depth = 0
    while len(live):
        over = tests.length[live] == depth
        ended(live[over], low[over], high[over], depth)
        live, low, high = live[~over], low[~over], high[~over]
        wanted = tests.words[tests.begin[live] + depth]
        deeper_low, deeper_high = narrowed(words, order, low, high, depth, wanted)
        ended(live, low, deeper_low, depth)
        ended(live, deeper_high, high, depth)
        going = deeper_low < deeper_high
        live, low, high = live[going], deeper_low[going], deeper_high[going]
        depth += 1
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int | None, str | None]]]:
    chars = benchmark.agg(F.sum(F.length(text))).first()[0] or 0
    count = -(-chars // MAX_ITEM_CHARS) or 1
    rows = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")).distinct()
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(count)) == k)
        yield sorted(((r["id"], r["text"]) for r in part.collect()), key=repr)


SEEN = ("n_words long, hits array<struct<start:long,end:long>>, items array<long>, "
        "longest struct<n_words:long,start:long,item:long>")


def searched(documents: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW,
             text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Columns ``keep`` with what each whole text shares with the benchmark.

    ``n_words``; ``hits``, the ranges of words (from 0, end exclusive) inside occurrences of windows,
    disjoint and in order; ``items``, the sorted ids of the items with an occurring window; ``longest``, the first of
    the longest verbatim matches of a window or more, or NULL.
    """
    unseen = F.lit(None).cast(T.StructType.fromDDL(SEEN)).alias("seen")
    rows = documents.select(F.struct(*keep).alias("kept"), F.col(text).alias("t"), unseen)
    for k, block in enumerate(_blocks(benchmark, item_id, item_text)):
        rows = _searched_block(stored(rows, "decontaminate") if k else rows, suffixes(block, window))
    return rows.select("kept.*", "seen.*")


def _searched_block(rows: DataFrame, tests: Suffixes) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(tests)
    schema = rows.schema

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = shared.value
        kind = pa.struct([
            ("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(pa.int64())),
            ("longest", pa.struct([("n_words", pa.int64()), ("start", pa.int64()), ("item", pa.int64())]))])
        pattern, number = re.compile(WORDS), tests.vocabulary.get

        def numbers_of(text: str) -> np.ndarray:
            text = text.encode().translate(LOWER).decode()
            words = pattern.findall(text) if len(text) <= RUN else (m[0] for m in pattern.finditer(text))
            return np.fromiter((number(w, END) for w in words), np.int64)

        for batch in batches:
            texts, before = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            low = 0
            while low < len(texts):
                numbers, starts, size, high = [], [0], 0, low
                while high < len(texts) and (high == low or size + len(texts[high] or "") <= RUN):
                    own = numbers_of(texts[high] or "")
                    numbers += [own, [END]]
                    starts.append(starts[-1] + len(own) + 1)
                    size += len(texts[high] or "")
                    high += 1
                seen = _per_text(np.concatenate(numbers), np.array(starts), tests)
                seen = [merged(a, b) for a, b in zip(before[low:high], seen)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low),
                     pa.array(seen, kind)], batch.schema.names)
                low = high

    return rows.mapInArrow(search, schema)


def _per_text(numbers: np.ndarray, starts: np.ndarray, tests: Suffixes) -> list[dict]:
    out = [{"n_words": int(n) - 1, "hits": [], "items": [], "longest": None} for n in np.diff(starts)]
    suffix, place, agree = longest_matches(numbers, tests)
    if not len(suffix):
        return out
    size = len(numbers) + 1  # from each place to the end of its longest match, every word is hit
    inside = np.cumsum(np.bincount(place, minlength=size) - np.bincount(place + agree, minlength=size)) > 0
    change = np.flatnonzero(np.diff(np.concatenate([[False], inside])))
    text = np.searchsorted(starts, change[0::2], "right") - 1
    for k, start, end in zip(text, change[0::2], change[1::2]):
        out[k]["hits"].append({"start": int(start - starts[k]), "end": int(end - starts[k])})
    text = np.searchsorted(starts, place, "right") - 1
    for k, item in np.unique(np.stack([text, tests.item[suffix]], 1), axis=0).tolist():
        out[k]["items"].append(tests.ids[item])
    best = np.lexsort((tests.item[suffix], place, -agree, text))
    first = best[np.unique(text[best], return_index=True)[1]]
    for k, start, n, item in zip(text[first], place[first], agree[first], tests.item[suffix[first]]):
        out[k]["longest"] = {"n_words": int(n), "start": int(start - starts[k]), "item": tests.ids[item]}
    for seen in out:
        seen["items"] = sorted({i for i in seen["items"] if i is not None})
    return out


def merged(before: dict | None, now: dict) -> dict:
    """What a text shares with earlier blocks of items and with this one."""
    if before is None:
        return now
    hits: list[dict] = []
    for span in sorted(before["hits"] + now["hits"], key=lambda s: (s["start"], s["end"])):
        if hits and span["start"] <= hits[-1]["end"]:
            hits[-1] = {"start": hits[-1]["start"], "end": max(hits[-1]["end"], span["end"])}
        else:
            hits.append(span)
    found = [x for x in (before["longest"], now["longest"]) if x]
    longest = min(found, key=lambda x: (-x["n_words"], x["start"])) if found else None
    return now | {"hits": hits, "items": sorted({*before["items"], *now["items"]}), "longest": longest}


def judged(documents: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW) -> DataFrame:
    """Columns ``keep`` with counts of words, hit words and items, a digest of the items, and ``contaminated``."""
    seen = searched(documents, benchmark, keep, window)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return seen.select(
        *keep, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def cleaned(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with their own columns, that hold no window of the benchmark."""
    whole = documents.select("text", F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole_row"))
    return searched(whole, benchmark, ["whole_row"], window).where(F.size("hits") == 0).select("whole_row.*")

