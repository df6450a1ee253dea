"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histogram over character classes and its histogram over the common words of its
language are compared with references of that language by the Jensen-Shannon distance (square root
of the divergence in bits, 0 to 1). The references are the mean histograms of the corpus itself,
over the documents that pass the base rules; shares are counted in millionths, so that the sums are
exact and do not depend on the order of rows. Four languages have a list of common words here; the
others of the corpus take their own most frequent words, counted over all their documents.

Defined results: NULL or empty text has no words, fails the base rules and is not kept. A document
is judged by a histogram only above a minimum length (``MIN_CHARS``, ``MIN_WORDS``); shorter
documents are kept if they pass the base rules. A document without a language, or in one of fewer than
``MIN_LIST_DOCS`` documents or beyond the ``MAX_LISTS`` most frequent of those without a list here, is
judged by its smallest distance to any reference. A distance is NULL, and rejects nothing, where a
histogram has no counts or there is no reference at all. Repeated rows get the same verdict each.
Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from review_pulse.llm.shared import SPACE, WORD, let, stored, text_words

# The sixteen most usual words of each language.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on with as be at",
    "fr": "de la le et les des en un du que une est par pour qui dans",
    "de": "der die und in den von zu das mit sich des auf für ist im ein",
    "es": "de la que el en del y los se las un no por con una su",
}
# Character classes, as the inside of a bracket expression; the rest is one more.
CLASSES = [r"\p{Ll}", r"\p{Lu}", r"\p{N}", SPACE, r".,;:!?", r"#*$%&|<>"]

WORDS, OWN_LIST = "_quality_words", "_quality_list"  # working columns
LIST_WORDS = 16
MIN_LIST_DOCS = 5
MAX_LISTS = 512
MILLION = 1_000_000
MIN_CHARS = 200
MIN_WORDS = 100
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.30


def repeated_window_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Each window becomes one long, its hash above the bits of its place. Sorted, windows of one hash are
    neighbours and are compared word by word; where neighbours share the hash but not the words, the
    window is looked for among all windows of that hash.
    """
    def same(w: Column, i: Column, j: Column) -> Column:
        return (F.get(w, i) == F.get(w, j)) & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2))

    def places(w: Column, mask: Column) -> Column:
        starts = F.slice(w, 1, F.size(w) - 2)
        packed = F.transform(starts, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(
            F.bitwise_not(mask)) + i)

        def near(x: Column, y: Column) -> Column:
            return x.bitwiseXOR(y).bitwiseAND(F.bitwise_not(mask)) == 0

        def alike(x: Column, y: Column) -> Column:
            return same(w, x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int"))

        def repeated(s: Column, x: Column, k: Column) -> Column:
            after, before = F.get(s, k + 1), F.get(s, k - 1)
            return (near(x, after) & alike(x, after)) | (near(x, before) & alike(x, before)) | (
                (near(x, after) | near(x, before)) & F.exists(s, lambda y: near(x, y) & (x != y) & alike(x, y)))

        return let(F.sort_array(packed), lambda s: F.transform(s, lambda x, k: F.when(
            repeated(s, x, k), x.bitwiseAND(mask).cast("int"))))

    def covered(marked: Column) -> Column:
        return F.aggregate(
            F.transform(marked, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(marked, k + 1) - p, F.lit(3)))),
            F.lit(0).cast("long"), lambda total, step: total + step)

    place_bits = lambda w: F.when(F.size(w) < 1 << 20, F.lit((1 << 20) - 1)).otherwise(
        F.lit((1 << 31) - 1)).cast("long")
    repeated = lambda w: F.array_sort(F.filter(let(place_bits(w), lambda m: places(w, m)), lambda p: p.isNotNull()))
    return let(words, lambda w: F.when(F.size(w) > 3, let(repeated(w), covered)).otherwise(F.lit(0).cast("long")))


def base_counts(text: Column) -> dict[str, Column]:
    """The base counts of a text, from its column of words and its lines."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD))
    return {
        "n_words": F.size(WORDS).cast("long"),
        "word_chars": F.aggregate(WORDS, F.lit(0).cast("long"), lambda n, w: n + F.length(w)),
        "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
        "n_repeat_words": repeated_window_words(F.col(WORDS)),
    }


def class_counts(text: Column) -> Column:
    """Characters of each class, the last one being the rest."""
    whole = F.coalesce(text, F.lit(""))
    known = F.array(*[F.regexp_count(whole, F.lit(f"[{c}]")).cast("long") for c in CLASSES])
    return let(known, lambda k: F.concat(k, F.array(F.length(whole) - _total(k))))


def letter_runs(text: Column) -> Column:
    """Lower-cased runs of letters."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), lambda w: w != "")


def word_lists(documents: DataFrame) -> dict[str, list[str]]:
    """The fixed lists, and the most frequent words of the most frequent other languages."""
    others = documents.where(F.col("lang").isNotNull() & ~F.col("lang").isin(list(COMMON_WORDS)))
    ranked = others.groupBy("lang").count().where(F.col("count") >= MIN_LIST_DOCS)
    ranked = ranked.orderBy(F.desc("count"), "lang").limit(MAX_LISTS)
    names = [r["lang"] for r in ranked.collect()]
    lists = {name: words.split() for name, words in COMMON_WORDS.items()}
    if names:
        words = others.where(F.col("lang").isin(names)).select("lang", F.explode(letter_runs(F.col("text"))).alias("word"))
        order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
        top = words.groupBy("lang", "word").agg(F.count("*").alias("n")).withColumn("rank", F.row_number().over(order))
        lists |= {name: [] for name in sorted(names)}
        for r in top.where(F.col("rank") <= LIST_WORDS).orderBy("lang", "rank").collect():
            lists[r["lang"]].append(r["word"])
    return lists


def common_counts(text: Column, lists: list[Column], every: list[str]) -> Column:
    """For each of some word lists, occurrences of each of its words, and of all other words.

    ``every`` has the words of all lists: most words of a text are in none and are looked up once.
    """
    def counted(all_words: Column) -> Column:
        usual = F.filter(all_words, lambda w: w.isin(every))
        return let(usual, lambda u: F.transform(F.array(*lists), lambda words: let(
            F.transform(words, lambda c: F.size(F.filter(u, lambda w: w == c)).cast("long")),
            lambda n: F.concat(n, F.array(F.size(all_words) - _total(n))))))

    return let(letter_runs(text), counted)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda n, v: n + v)


def shares(counts: Column) -> Column:
    """Counts as millionths of their total, rounded down; all zero for a total of zero."""
    return let(counts, lambda c: let(F.greatest(_total(c), F.lit(1)), lambda total: F.transform(
        c, lambda n: F.floor(n * F.lit(MILLION) / total).cast("long"))))


def distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance of two histograms of one length; NULL if either is NULL or empty."""
    def part(x: Column, mean: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / mean)).otherwise(F.lit(0.0))

    def divergence(p: Column, q: Column) -> Column:
        terms = F.zip_with(p, q, lambda a, b: let((a + b) / 2, lambda m: (part(a, m) + part(b, m)) / 2))
        total = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
        return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(total, F.lit(0.0))))

    def normal(h: Column) -> Column:
        return let(_total(h), lambda total: F.when(total > 0, F.transform(h, lambda n: n / total)))

    return let(normal(left), lambda p: let(normal(right), lambda q: divergence(p, q)))


def measured(documents: DataFrame, keep: list[str], lists: dict[str, list[str]]) -> DataFrame:
    """Columns ``keep`` with base counts, ``base_failed`` and both histograms."""
    text = F.col("text")
    literal = {name: F.array(*map(F.lit, words)).cast("array<string>") for name, words in lists.items()}
    by_language = F.create_map(*[x for name, words in literal.items() for x in (F.lit(name), words)])
    every = sorted({w for words in lists.values() for w in words})
    counted = documents.withColumns({WORDS: text_words(text), OWN_LIST: F.try_element_at(by_language, F.col("lang"))}).select(
        F.struct(*keep).alias("kept_columns"),
        F.col("lang").alias("language"),
        *[c.alias(n) for n, c in base_counts(text).items()],
        F.length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars_read"),
        class_counts(text).alias("class_counts"),
        F.when(F.col(OWN_LIST).isNotNull(), common_counts(text, [F.col(OWN_LIST)], every)[0]).alias("common_counts"),
        F.when(F.col(OWN_LIST).isNull(), common_counts(text, list(literal.values()), every)).alias("counts_by_list"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def references(rows: DataFrame) -> DataFrame:
    """One row per listed language: summed shares of the documents that pass the base rules."""
    used = rows.where(~F.col("base_failed") & F.col("common_counts").isNotNull())
    width = len(CLASSES) + 1
    words = 1 + LIST_WORDS
    spread = used.select(
        "language", shares(F.col("class_counts")).alias("c"), shares(F.col("common_counts")).alias("w")
    )
    return spread.groupBy("language").agg(
        F.array(*[F.sum(F.col("c")[k]) for k in range(width)]).alias("class_reference"),
        F.filter(F.array(*[F.sum(F.get("w", F.lit(k))) for k in range(words)]), lambda n: n.isNotNull()).alias("word_reference"),
    )


def judged(documents: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with the base counts, both distances and the verdict ``kept``.

    The measures are stored once, so that texts are analysed a single time for references and verdicts.
    """
    lists = word_lists(documents)
    rows = stored(measured(documents, keep, lists), "quality-measures")
    every = references(rows).agg(F.collect_list(
        F.struct("language", "class_reference", "word_reference")).alias("references"))  # a row per listed language
    both = rows.crossJoin(F.broadcast(every)).withColumn(
        "own", F.get(F.filter("references", lambda r: r["language"] == F.col("language")), F.lit(0)))
    listed = F.col("common_counts").isNotNull()

    def nearest(counts: Callable[[Column], Column], reference: str) -> Column:
        return F.array_min(F.transform("references", lambda r: distance(shares(counts(r)), r[reference])))

    names = F.array(*map(F.lit, lists))
    class_distance = F.when(F.col("n_chars_read") >= MIN_CHARS, F.when(
        listed, distance(shares(F.col("class_counts")), F.col("own.class_reference"))).otherwise(
        nearest(lambda r: F.col("class_counts"), "class_reference")))
    word_distance = F.when(F.col("n_words") >= MIN_WORDS, F.when(
        listed, distance(shares(F.col("common_counts")), F.col("own.word_reference"))).otherwise(
        nearest(lambda r: F.get("counts_by_list", F.array_position(names, r["language"]).cast("int") - 1), "word_reference")))
    return both.select(
        "kept_columns.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.round(class_distance, 6).alias("class_distance"),
        F.round(word_distance, 6).alias("word_distance"),
    ).withColumn(
        "kept",
        ~F.col("base_failed")
        & F.coalesce(F.col("class_distance") <= MAX_CLASS_DISTANCE, F.lit(True))
        & F.coalesce(F.col("word_distance") <= MAX_WORD_DISTANCE, F.lit(True)),
    )
