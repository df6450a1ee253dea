"""Spelling variants, decontamination and lexical search: brute force, edge rows, bounded work."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from review_pulse.llm import decontaminate, lexical, spelling

SCHEMA = "doc_id long, text string, word string, n long, kept string, hits int, whole_row string"
LONG = " ".join(f"w{i % 977} the and" for i in range(60_000))
EDGES = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (4, "One two"), (5, LONG), (6, LONG), (None, "no id here"), (7, "!! ÷"),
         (8, "x" * 50_000 + " " + "y" * 50_000)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(*row, "a", 1, "b", 2, "c") for row in EDGES], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


# spelling variants

def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def naive_variants(counts, factor):
    out = {}
    for word, n in counts.items():
        near = [w for w in counts if one_edit(w, word)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best and counts[best] >= factor * n else None
        out[word] = [form, None, n, len(near), counts[form] if form else None]
    for word, row in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        row[1] = root
    return {word: tuple(row) for word, row in out.items()}


@pytest.mark.parametrize("ranges", [1, 7])
def test_variants_equal_brute_force(spark, ranges):
    draw = random.Random(ranges)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 7))) for _ in range(250)}
    words |= {"x" * 300, "x" * 301, "x" * 150 + "y" + "x" * 150, "aaaa𐐷aaa", "aaaaaaa", "aaaaaaaa"}
    counts = {w: draw.choice([1, 2, 3, 30, 300, 3000, 30000]) for w in words}
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
               for r in spelling.variants(rows, min_length=1, min_count=1).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == naive_variants(counts, 10)


def test_chain_of_forms_is_followed_to_its_end(spark):
    rows = [("abcdefg" + "z" * k, 2 * 10**(9 - k)) for k in range(10)]
    got = {r["word"]: r["root"] for r in spelling.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert set(got.values()) == {"abcdefg"} and len(got) == 10


def test_pairs_hold_at_most_one_word_for_each_letter(spark):
    words = [("abcde" + a + b, 2) for a in "abcdefgh" for b in "abcdefgh"]  # many words in one neighbourhood
    table = spark.createDataFrame(words, "word string, n long")
    forward, same_prefix = spelling.numbered(table, "word", "forward", "number")
    both, same_suffix = spelling.numbered(forward.selectExpr("*", "reverse(word) AS r"), "r", "backward")
    pairs = spelling.node_pairs(both, same_prefix, same_suffix)
    assert pairs.count() == 64 * 15
    assert pairs.groupBy("prefix", "suffix").count().agg({"count": "max"}).first()[0] == 8
    met = spelling.neighbours(pairs)
    assert {r["n_near"] for r in met.collect()} == {14}


def test_slips_lose_the_named_code_point(spark):
    import zlib

    rows = [(i, "Hello wörld again ÀB") for i in range(100)] + [(None, "hello")]
    want = Counter()
    for own, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", "".join(c.lower() if c.isascii() else c for c in text)):
            h = zlib.crc32(f"{'' if own is None else own}:{run}".encode())
            want[run[:h % len(run)] + run[h % len(run) + 1:] if h % 7 == 0 else run] += 1
    got = spelling.word_counts(spark.createDataFrame(rows, "doc_id long, text string"), slips=7)
    assert {r["word"]: r["n"] for r in got.collect()} == dict(want)


def test_spelling_edges(edges, empty):
    assert spelling.variants(spelling.word_counts(empty, slips=31)).count() == 0
    got = {r["word"] for r in spelling.variants(spelling.word_counts(edges), min_length=3).collect()}
    assert got == {"the", "and", "one", "two"}
    assert spelling.variants(spelling.word_counts(edges), min_length=1, min_count=1).count() >= 9
    with pytest.raises(ValueError):
        spelling.variants(spelling.word_counts(empty), factor=1)


# decontamination

def naive_hits(text, items, window):
    words = decontaminate.words_of(text)
    hit, ids = set(), set()
    for item_id, item in items:
        own = decontaminate.words_of(item)
        size = min(window, len(own))
        windows = {tuple(own[k:k + size]) for k in range(len(own) - size + 1)} if own else set()
        for k in range(len(words) - size + 1):
            if tuple(words[k:k + size]) in windows:
                hit |= set(range(k, k + size))
                ids.add(item_id)
    return len(words), len(hit), sorted(ids - {None})


@pytest.mark.parametrize("block_chars", [10**6, 150])
def test_decontamination_equals_brute_force(spark, monkeypatch, block_chars):
    monkeypatch.setattr(decontaminate, "MAX_ITEM_CHARS", block_chars)
    draw = random.Random(5)
    item = lambda n: " ".join(draw.choice(["a", "b", "c", "É", "1"]) for _ in range(n))
    items = [(k, item(draw.choice([0, 1, 3, 6, 15, 30]))) for k in range(25)]
    items += [(3, item(8)), (None, item(9)), (30, None), (31, items[7][1]), (31, items[7][1])]
    texts = [(k, item(draw.randint(0, 60)) + "; " + (items[k % 25][1] or "").upper()) for k in range(60)]
    texts += [(99, None), (5, texts[5][1])]
    got = decontaminate.searched(spark.createDataFrame(texts, "doc_id long, text string"), items_of(spark, items), ["doc_id", "text"], window=6)
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        hit = sum(s["end"] - s["start"] for s in r["hits"])
        assert (r["n_words"], hit, r["items"]) == naive_hits(r["text"], items, 6)


def test_longest_match_and_cleaned_documents(spark):
    words = [f"w{i}" for i in range(40)]
    items = items_of(spark, [(1, " ".join(words)), (2, "w3 w4 w5 other")])
    texts = [(1, "x y " + " ".join(words[2:30]) + " w3"), (2, " ".join(words[:9])), (3, "A w3 w4 W5 OTHER"), (4, None)]
    documents = spark.createDataFrame([(*t, 0, "own") for t in texts], "doc_id long, text string, hits int, whole_row string")
    got = {r["doc_id"]: r for r in decontaminate.searched(documents, items, ["doc_id"]).collect()}
    assert got[1]["longest"].asDict() == {"n_words": 28, "start": 2, "item": 1} and got[2]["longest"] is None
    assert [s.asDict() for s in got[3]["hits"]] == [{"start": 1, "end": 5}] and got[3]["items"] == [2]
    kept = decontaminate.cleaned(documents, items)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4]


def test_judged_digest_sorts_ids_as_strings(spark):
    items = items_of(spark, [(10, "same words"), (9, "same words"), (100, "same words")])
    row = decontaminate.judged(spark.createDataFrame([(1, "the same WORDS")], "doc_id long, text string"), items, ["doc_id"]).first()
    assert (row["n_hit"], row["n_items"]) == (2, 3)
    assert row["items_sha256"] == hashlib.sha256(b"10,100,9").hexdigest()


def test_suffix_array_is_sorted():
    draw = np.random.default_rng(1)
    words = np.append(draw.integers(0, 4, 500), 0)
    order = decontaminate.suffix_array(words, 64)
    assert sorted(order) == list(np.flatnonzero(words))
    suffix = [tuple(words[i:i + 64]) for i in order]
    cut = [s[:s.index(0)] if 0 in s else s for s in suffix]
    assert cut == sorted(cut)


def test_decontamination_edges(spark, edges, empty):
    items = items_of(spark, [(1, "one two"), (2, None), (None, "id here"), (3, "x" * 50_000)])
    got = decontaminate.judged(edges, items, ["doc_id", "kept"])
    rows = got.collect()
    assert len(rows) == len(EDGES)
    assert sorted((r["doc_id"] or 0, r["n_hit"], r["n_items"]) for r in rows if r["n_hit"]) == [(0, 2, 0), (4, 2, 1), (4, 2, 1), (8, 1, 1)]
    assert decontaminate.judged(empty, items, ["doc_id"]).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.judged(edges, items_of(spark, []), ["doc_id"]).collect())


# lexical search

def naive_ranks(texts, queries, k):
    counted = [(own, Counter(lexical.terms_of(text))) for own, text in texts]
    documents = sum(bool(c) for _, c in counted)
    words = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in queries:
        scores = []
        for own, c in counted:
            m = 25 + 75 * sum(c.values()) * documents // max(words, 1)
            score = sum(int(1000 * np.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in lexical.terms_of(text) if c[t])
            if score > 0:
                scores.append((-score, own is None, own or 0))
        out += [(item, rank, None if no_id else own, -score)
                for rank, (score, no_id, own) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def lexical_texts(seed, count):
    draw = random.Random(seed)
    rank = lambda: f"t{int(draw.paretovariate(0.6)) % 300}"
    texts = [(k, " ".join(rank() for _ in range(draw.randint(0, 80)))) for k in range(count)]
    return texts + [(7, texts[7][1]), (None, texts[8][1]), (900, None), (901, "Ünï ÜNÏ 12")]


def test_search_equals_brute_force(spark):
    texts = lexical_texts(2, 300)
    queries = [(k, " ".join(t.split()[0] for _, t in texts[k:k + 9] if t)) for k in range(40)]
    queries += [(1, None), (2, "absent"), (50, "t1 T1 t1"), (50, "t1 T1 t1"), (51, "ünï")]
    documents = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = lexical.ranked(documents, items_of(spark, queries))
    assert sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in got.collect()), key=repr) == naive_ranks(texts, queries, 10)


def test_bounds_reject_blocks_before_they_are_unpacked(monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", 4)
    texts = lexical_texts(3, 2000)
    counted = [(own, Counter(lexical.terms_of(t))) for own, t in texts]
    df = Counter(t for _, c in counted for t in c)
    documents = sum(bool(c) for _, c in counted)
    words = sum(sum(c.values()) for _, c in counted)
    weights = {t: int(1000 * np.log((2 * documents + 2) / (2 * n + 1))) for t, n in df.items()}
    statistics = lexical.Collection(documents, words, weights)
    shards = []
    for low in range(0, len(texts), 100):
        some, terms = texts[low:low + 100], {}
        rows = [np.array([terms.setdefault(t, len(terms)) for t in lexical.terms_of(x)], np.int64) for _, x in some]
        shards.append(lexical.shard_row([i for i, _ in some], rows, terms))
    none = np.empty(0, np.int64)
    queries = [(k, " ".join(f"t{j}" for j in (1, 2, 3, 5, 20 + k, 60 + k))) for k in range(10)]
    got, opened, blocks = [], 0, 0
    for item, text in queries:
        best = lexical.Best(none, none, none)
        for row in shards:
            shard = lexical.Shard(row)
            lists = [(shard.place[t], n * weights[t]) for t, n in Counter(lexical.terms_of(text)).items() if t in shard.place]
            lexical.scored_shard(shard, lexical.impact(shard.top_tf, statistics.penalty(shard.least_length)),
                                 statistics.penalty(shard.lengths), lists, best, 10)
            opened += shard.opened
            blocks += sum(int(shard.begin[t + 1] - shard.begin[t]) for t, _ in lists)
        got += [(item, rank, None if no_id else int(own), int(score)) for rank, (own, no_id, score) in
                enumerate(zip(best.ids, best.no_id, best.score), 1)]
    assert sorted(got, key=repr) == naive_ranks(texts, queries, 10)
    assert opened < 0.7 * blocks


def test_search_goes_on_over_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(lexical, "MAX_QUERY_CHARS", 20)
    texts = lexical_texts(4, 60)
    queries = [(k, f"t{k} t1 t2") for k in range(12)]
    got = lexical.ranked(spark.createDataFrame(texts, "doc_id long, text string"), items_of(spark, queries), k=3)
    assert sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in got.collect()), key=repr) == naive_ranks(texts, queries, 3)


def test_search_edges(spark, edges, empty):
    queries = items_of(spark, [(1, "one id"), (2, None), (None, "the w5"), (3, "x" * 50_000)])
    got = lexical.ranked(edges, queries).collect()
    want = naive_ranks(EDGES, [(1, "one id"), (2, None), (None, "the w5"), (3, "x" * 50_000)], 10)
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=repr) == want
    assert lexical.ranked(empty, queries).count() == 0
    assert lexical.ranked(edges, items_of(spark, [])).count() == 0


# picking rows by bits of their ids

@pytest.mark.parametrize("bits", [1 << 25, 1 << 12])
def test_rows_are_dropped_exactly(spark, monkeypatch, bits):
    from review_pulse.llm import minhash_dedup

    monkeypatch.setattr(minhash_dedup, "MAX_BITS", bits)  # with few bits nearly all rows look dropped
    rows = spark.range(20_000).selectExpr("id AS number", "id * 2 AS more")
    dropped = spark.range(0, 20_000, 7)
    got = {r["number"] for r in minhash_dedup.without(rows, "number", dropped).collect()}
    assert got == {k for k in range(20_000) if k % 7}
    asked = minhash_dedup.may_be_in(dropped)
    assert dropped.where(asked(dropped["id"])).count() == dropped.count()
    assert minhash_dedup.without(rows, "number", dropped.where("id < 0")).count() == 20_000
