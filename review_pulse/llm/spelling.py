"""Spelling variants: words one edit apart, found by a dictionary of trie-node pairs.

Words are numbered along two tries, one of the words and one of the reversed words: in sorted order a
word shares the nodes of its common prefix with the word before it and opens new ones for the rest,
so a node is an integer that stands for exactly one prefix (or suffix). Every word gives the pair
(prefix node, suffix node) around each of its places: with the place between them skipped, and with
nothing skipped. Two words that differ by one replaced code point meet in a pair that both skip;
a word and the same word with one code point more meet in a pair that only the longer one skips.
Nothing else meets, so neighbours are exact. A pair is shared by at most one word for each letter of
the alphabet, and one task reads the sorted pairs as a stream: nothing grows with the corpus.

Sorted ranges are numbered side by side. A range whose first word shares a prefix with the last word
of the range before takes over that prefix's numbers; the driver sees two words per range for this.

Defined results: NULL or wordless texts give no words; a NULL id is spelled as an empty one; repeated
rows count again; equal counts are settled by code-point order; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_pulse.llm.shared import remove, stored

RUNS = "[a-zÀ-ÿ]+"
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
FLUSH = 1 << 18  # distinct words that a task holds before it sends them on
CHUNK = 1 << 18  # pairs that are compared at once
RANGE = 40  # bits of a number within its range
ROOT = -1
WHOLE, SKIPPED, FIRST_SKIPPED = 0, 1, 2


def word_counts(documents: DataFrame, slips: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n``, the number of its occurrences, of all runs of letters with A-Z lower-cased.

    With ``slips``, an occurrence for which crc32 of ``<doc_id>:<run>`` is divisible by it loses the
    code point at that checksum modulo its length.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, total = re.compile(RUNS).findall, Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = Counter(find((text or "").encode().translate(LOWER).decode()))
                if slips:
                    start = zlib.crc32(f"{own or ''}:".encode())
                    for word, n in seen.items():
                        check = zlib.crc32(word.encode(), start)
                        if check % slips == 0:
                            place = check % len(word)
                            word = word[:place] + word[place + 1:]
                        total[word] += n
                else:
                    total.update(seen)
                if len(total) >= FLUSH:
                    yield sent()
                    total.clear()
        yield sent()

    pairs = documents.select(F.col(doc_id).cast("string"), F.col(text).alias("t"))
    return pairs.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common(one: str, other: str) -> int:
    """Length of the common prefix."""
    least = min(len(one), len(other))
    if one[:least] == other[:least]:
        return least
    return next(i for i in range(least) if one[i] != other[i])


def numbered(words: DataFrame, spelled: str, nodes: str, own: str | None = None) -> tuple[DataFrame, np.ndarray]:
    """``words`` with ``nodes``, the trie nodes of the prefixes of column ``spelled`` (distinct strings).

    The second result maps nodes that continue another range's prefix to that range's nodes. With
    ``own``, a column of that name numbers the words in their order.
    """
    sorted_words = words.repartitionByRange(spelled).sortWithinPartitions(spelled)
    place = sorted_words.columns.index(spelled)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << RANGE
        rows, used, before, path = 0, 0, "", []
        for batch in batches:
            flat, ends = [], [0]
            for word in batch.column(place).to_pylist():
                same = common(before, word)
                path = path[:same] + list(range(base + used, base + used + len(word) - same))
                used += len(word) - same
                before = word
                flat += path
                ends.append(len(flat))
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            numbers = pa.array(np.arange(rows, rows + batch.num_rows) + base, pa.int64())
            rows += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, listed, numbers], [*batch.schema.names, nodes, own or "own"])

    columns = {nodes: F.array(F.lit(0).cast("long")), own or "own": F.lit(0).cast("long")}
    out = stored(sorted_words.mapInArrow(number, words.withColumns(columns).schema), f"spelling-{nodes}")
    number_column = F.col(own or "own")
    ends = out.groupBy(F.shiftright(number_column, RANGE).alias("range")).agg(*[
        pick(F.struct(F.col(spelled).alias("word"), F.col(nodes).alias("nodes")), number_column).alias(name)
        for pick, name in ((F.min_by, "first"), (F.max_by, "last"))])
    return (out if own else out.drop("own")), continued(sorted(ends.collect(), key=lambda r: r["range"]))


def continued(ranges: list) -> np.ndarray:
    """Two rows, sorted by the first: nodes that a range opened anew, and the nodes they stand for."""
    same: dict[int, int] = {}
    before, path = "", []
    for r in ranges:
        for old, new in zip(r["first"]["nodes"][:common(before, r["first"]["word"])], path):
            same[old] = new
        before, path = r["last"]["word"], [same.get(x, x) for x in r["last"]["nodes"]]
    return np.array(sorted(same.items()), np.int64).reshape(-1, 2).T.copy()


def resolved(nodes: np.ndarray, same: np.ndarray) -> np.ndarray:
    at = np.searchsorted(same[0], nodes)
    found = at < same.shape[1]
    found[found] = same[0][at[found]] == nodes[found]
    out = nodes.copy()
    out[found] = same[1][at[found]]
    return out


def node_pairs(words: DataFrame, same_prefix: np.ndarray, same_suffix: np.ndarray) -> DataFrame:
    """``prefix`` and ``suffix`` node, ``word`` (its number and what is between them) and ``n``."""
    shared = words.sparkSession.sparkContext.broadcast((same_prefix, same_suffix))

    def sent(columns: list[list[np.ndarray]]) -> pa.RecordBatch:
        prefix, suffix, word, n = map(np.concatenate, columns)
        prefix, suffix = map(resolved, (prefix, suffix), shared.value)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (prefix, suffix, word, n)],
                                          ["prefix", "suffix", "word", "n"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            size = 0
            for word, number, n, forward, backward in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                    batch.column(3), batch.column(4)):
                prefix = np.concatenate([[ROOT], forward.values.to_numpy()])
                suffix = np.concatenate([[ROOT], backward.values.to_numpy()])[::-1]
                letters = np.array([*map(ord, word)])
                kind = np.full(2 * len(word) + 1, WHOLE)
                kind[:len(word)] = SKIPPED + (np.diff(letters, prepend=-1) != 0)
                for column, values in zip(out, (
                        np.concatenate([prefix[:-1], prefix]), np.concatenate([suffix[1:], suffix]),
                        number << 2 | kind, np.full(len(kind), n))):
                    column.append(values)
                size += len(kind)
                if size >= CHUNK:
                    yield sent(out)
                    out, size = [[], [], [], []], 0
            if size:
                yield sent(out)

    return words.select("word", "number", "n", "forward", "backward").mapInArrow(
        emit, "prefix long, suffix long, word long, n long")


def met(prefix: np.ndarray, suffix: np.ndarray, word: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    """Words that meet in sorted, complete pairs: word, how many it meets, the best's count and number."""
    new = np.ones(len(prefix), bool)
    new[1:] = (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])
    pair = np.cumsum(new) - 1
    shared = (np.bincount(pair) > 1)[pair]
    pair, word, n = pair[shared], word[shared], n[shared]
    kind, number = word & 3, word >> 2
    order = np.lexsort((number, -n, kind == WHOLE, pair))
    pair, kind, number, n = pair[order], kind[order], number[order], n[order]
    found = []

    def add(rows: np.ndarray, count: np.ndarray, best: np.ndarray) -> None:
        found.append(np.stack([number[rows], count, n[best], number[best]]))

    def starts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first of the rows of each pair, and the number of rows of each pair, for each row."""
        _, begin, inverse, count = np.unique(pair[rows], return_index=True, return_inverse=True, return_counts=True)
        return begin[inverse], count[inverse]

    skipped = np.flatnonzero(kind != WHOLE)
    begin, count = starts(skipped)
    several = count > 1
    skipped, begin, count = skipped[several], begin[several], count[several]
    if len(skipped):
        rows = np.flatnonzero(kind != WHOLE)
        add(skipped, count - 1, np.where(rows[begin] == skipped, rows[begin + 1], rows[begin]))
    whole = np.flatnonzero(kind == WHOLE)
    longer = np.flatnonzero(kind == FIRST_SKIPPED)
    if len(whole) and len(longer):
        at = np.minimum(np.searchsorted(pair[whole], pair[longer]), len(whole) - 1)
        fits = pair[whole[at]] == pair[longer]
        longer, partner = longer[fits], whole[at[fits]]
        add(longer, np.ones(len(longer), np.int64), partner)
        begin, count = starts(longer)
        first = begin == np.arange(len(longer))
        add(partner[first], count[first], longer[first])
    return [np.concatenate(x) for x in zip(*found)] if found else [np.empty(0, np.int64)] * 4


def neighbours(pairs: DataFrame) -> DataFrame:
    """``number`` of a word, ``n_near`` and ``best``, the count (negative) and number of its best neighbour."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compared(last: bool) -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate([b.column(k).to_numpy() for b in held]) for k in range(4)]
            cut = len(columns[0])
            if not last:  # the last pair may go on
                cut = int(np.searchsorted(columns[0], columns[0][-1]))
                cut += int(np.searchsorted(columns[1][cut:], columns[1][-1]))
            names = ["number", "met", "n", "best"]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in met(*[c[:cut] for c in columns])], names)
            held[:] = [pa.RecordBatch.from_arrays([pa.array(c[cut:]) for c in columns], held[0].schema.names)]

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= CHUNK:
                yield from compared(False)
        if held:
            yield from compared(True)

    ordered = pairs.repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix")
    rows = ordered.mapInArrow(compare, "number long, met long, n long, best long")
    return rows.groupBy("number").agg(
        F.sum("met").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "best")).alias("best"))


def variants(words: DataFrame, min_length: int = 7, min_count: int = 2, factor: int = 10) -> DataFrame:
    """Every word of ``word``, ``n`` with enough code points and occurrences, and its neighbours.

    ``n_near`` counts the words one edit away; ``form`` is the most frequent of them if it occurs at
    least ``factor`` times as often, ``form_n`` its count, and ``root`` the end of the chain of forms.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more: chains of forms would not end")
    used = words.where((F.length("word") >= min_length) & (F.col("n") >= min_count))
    used = stored(used, "spelling-words")
    forward, same_prefix = numbered(used, "word", "forward", "number")
    both, same_suffix = numbered(forward.withColumn("reversed", F.reverse("word")), "reversed", "backward")
    near = stored(neighbours(node_pairs(both, same_prefix, same_suffix)), "spelling-near")
    linked = both.select("number", "word", "n").join(near, "number", "left")
    likely = -F.col("best.n") >= factor * F.col("n")
    linked = stored(linked.select(
        "number", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(likely, F.col("best.best")).alias("form"), F.when(likely, -F.col("best.n")).alias("form_n"),
    ), "spelling-linked")
    follow = linked.where("form IS NOT NULL").select("number", F.col("form").alias("root"))
    for _ in range(steps(linked, factor)):  # each step doubles the part of the chain that is followed
        ahead = follow.select(F.col("number").alias("root"), F.col("root").alias("further"))
        follow = follow.join(ahead, "root", "left").select("number", F.coalesce("further", "root").alias("root"))
    spelled = linked.select("number", "word")
    out = linked.join(follow, "number", "left")
    for name in ("form", "root"):
        names = spelled.select(F.col("number").alias(name), F.col("word").alias(f"{name}_word"))
        out = out.join(names, name, "left")
    out = stored(out.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"),
        "n", "n_near", "form_n"), "spelling-variants")
    for table in (used, forward, both, near, linked):
        remove(table)
    return out


def steps(linked: DataFrame, factor: int) -> int:
    """Doublings that reach the end of any chain, since counts grow ``factor`` times from form to form."""
    ends = linked.agg(F.min("n").alias("least"), F.max("n").alias("most")).first()
    links, reached = 0, ends["least"] or 1
    while reached * factor <= (ends["most"] or 0):
        links, reached = links + 1, reached * factor
    return max(links - 1, 0).bit_length()
