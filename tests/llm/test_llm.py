"""Small tests of the training-data operators: edge rows, brute force, round trips, held-out accuracy."""

import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, differences
from review_pulse.llm import (
    byte_bpe, byte_cnn, bytewise, chat_format, exact_topk, language_id, masked_lm, minhash_dedup, mixing, oracle,
    quality_rules, queries, toxic_crf,
)
from review_pulse.llm.labelled import Sample, training_sample

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, size int"
LONG = " ".join(f"w{i % 977} the and" for i in range(60_000))
EDGES = [
    (1, None, None, None, None, None, None, None), (2, "", "en", "a", 0, 0.5, "x", 1), (3, " \n\t", "en", "a", 3, 0.5, "x", 1),
    (4, "one two", "en", "b", 7, 0.5, "x", 1), (4, "one two", "en", "b", 7, 0.5, "x", 1),
    (5, LONG, "en", None, len(LONG), 0.5, "x", 1), (6, LONG, "zz", "c", len(LONG), 0.5, "x", 1),
    (None, "no id here", "fr", "c", 10, 0.5, "x", 1), (7, "12 34 !!", None, "b", 8, 0.5, "x", 1),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(50)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_agrees_with_sql(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), oracle.SQL[name]) is None


def operators(documents, labels):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    yield masked_lm.scored(documents, masked_lm.blank_model(), ["doc_id"])
    yield quality_rules.judged(documents, ["doc_id"])
    yield mixing.mixed(documents, ["doc_id"])
    yield toxic_crf.scored(documents, toxic_crf.fit(training_sample(documents, labels, "toxic")), ["doc_id"])
    yield byte_cnn.scored(documents, byte_cnn.fit(training_sample(documents, labels, "quality"), epochs=1), ["doc_id"])
    yield minhash_dedup.marked(documents)
    yield byte_bpe.digests(documents, ranks, public_tokenizers.PATTERN, ["doc_id"])
    yield language_id.identified(documents, ["doc_id"])


def test_edge_rows_keep_their_number(edges, empty, labels):
    assert [df.count() for df in operators(edges, labels)] == [len(EDGES)] * 8
    assert [df.count() for df in operators(empty, labels)] == [0] * 8


def test_pipeline_stages_on_edge_rows(spark, edges, empty, sf_dir):
    for documents in (edges, empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, documents, sf_dir)
            assert name == "byte_bpe" or out.columns == documents.columns
            out.count()


def test_mix_reaches_its_targets(edges):
    rows = mixing.mixed(edges, ["doc_id", "source"]).toPandas()
    assert (rows["taken"] <= 2 * rows["size"]).all()
    for _, part in rows.groupby("source", dropna=False):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= len(part)


def naive_sets(text, width):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(words)} if 0 < len(words) < width else {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def test_dedup_components_equal_brute_force(spark):
    draw = random.Random(3)
    base = [f"t{i}" for i in range(120)]
    texts = []
    for _ in range(60):  # a chain of small edits: neighbours are alike, the ends are not
        base = base[:]
        base[draw.randrange(len(base))] = f"n{draw.random()}"
        texts.append(" ".join(base))
    texts += [" ".join(f"o{draw.random()}" for _ in range(30)) for _ in range(20)] + ["", None, "a b", "A B"]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in minhash_dedup.marked(
        spark.createDataFrame(rows, "doc_id long, text string"), width=4).collect()}
    sets = [naive_sets(t, 4) for t in texts]
    label = list(range(len(texts)))
    for x, y in itertools.combinations(range(len(texts)), 2):
        if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
            low, high = sorted((label[x], label[y]))
            label = [low if k == high else k for k in label]
    assert got == dict(enumerate(label))


def test_dedup_buckets_meet_in_bounded_blocks(spark):
    rows = [(k, b"", 0, 0 if k < 300 else k, 10) for k in range(360)]  # a large component and 60 outsiders
    members = spark.createDataFrame(rows, "id long, digest binary, bucket long, component long, bytes long")
    met, groups = set(), {}
    for r in minhash_dedup.in_blocks(members, 200).collect():
        groups.setdefault((r.first, r.second), []).append(r)
    for group in groups.values():
        assert sum(r.bytes for r in group) <= 1200
        for x, y in itertools.combinations(sorted(group, key=lambda r: r.id), 2):
            if x.component != y.component and (x.alike or x.late != y.late):
                assert (x.id, y.id) not in met
                met.add((x.id, y.id))
        assert not all(r.component == 0 for r in group)
    assert len(met) == 300 * 60 + 60 * 59 // 2


def test_dedup_in_small_blocks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_BYTES", 8 * minhash_dedup.MEMBER_BYTES)
    monkeypatch.setattr(minhash_dedup, "STAR_BANDS", 0)  # all links from the buckets
    test_dedup_components_equal_brute_force(spark)


def test_quality_of_rows_without_a_listed_language(spark):
    draw = random.Random(5)
    some = [f"{a}{b}" for a in ("mar", "ten", "sol", "pri") for b in ("ket", "der", "id", "ce", "ow")]
    words = lambda: draw.choices(some + quality_rules.COMMON_WORDS["en"].split(), k=150)
    good = [(i, " ".join(words()), "en") for i in range(20)]
    junk = " ".join(w + "###" for w in words())
    rows = good + [(20, junk, "en"), (21, junk, None), (22, junk, "zz"), (23, good[0][1], None), (24, good[0][1], "zz"),
                   (25, " ".join(map(str, range(150))), "en"), (26, " ".join(map(str, range(150))), None)]
    got = {r.doc_id: r for r in quality_rules.judged(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), ["doc_id"]).collect()}
    assert [got[i].kept for i in range(20, 25)] == [False] * 3 + [True] * 2
    assert got[21].class_distance == got[20].class_distance and got[23].word_distance == got[0].word_distance
    assert got[25].word_distance is None and got[26].word_distance is None


def test_dedup_keeps_one_row_of_repeated_and_missing_ids(spark):
    rows = [(4, "one two"), (4, "one two"), (4, "other text"), (9, "One two"), (None, "one  two"), (None, "no id"),
            (None, "no id"), (5, ""), (5, None)]
    got = minhash_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(4, "one two"), (4, "other text"), (None, "no id"), (5, ""), (5, None)], key=repr)


def test_bpe_equals_tiktoken(spark):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "a b  c  \n\n x", "!" * 5000, "x" * 1000, "don't we'LL 12345 <|endoftext|>", "日本語 😀 é",
             "\u0085a \x1c b\x1f  c", "Ⅷ²½ ٣", "ab" * 300 + " ü" * 90]
    coded = byte_bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ranks,
                            public_tokenizers.PATTERN, ["doc_id"])
    assert {r.doc_id: list(r.ids) for r in coded.collect()} == {
        i: reference.encode_ordinary(t or "") for i, t in enumerate(texts)}
    back = byte_bpe.decode(coded, ranks, ["doc_id"])
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_top_k_equals_brute_force_with_ties(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(-3, 4, (700, 6)) / 64
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(values)]
    rows += [(900, None), (901, [float("nan")] * 6), (902, [None, 1.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in exact_topk.top_k(df, F.col("vec_id") % 20 == 0, 20).collect()}
    exact = np.floor(values * 64).astype(int)
    for q in range(0, 700, 20):
        scores = exact @ exact[q]
        best = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:20]
        assert [got[q, k + 1] for k in range(20)] == [(i, -s) for s, i in best]


def test_bounds_enclose_scores():
    rng = np.random.default_rng(2)
    lists = exact_topk.SortedLists(np.arange(300), rng.integers(-20, 20, (300, 8)), np.float32)
    query = rng.integers(-20, 20, (5, 8)).astype(np.float32)
    up, low, neg_up, neg_low = lists.read(40)
    score = query @ lists.values.T
    positive, negative = np.maximum(query, 0), np.minimum(query, 0)
    assert (positive @ up.T + negative @ neg_up.T >= score).all()
    assert (positive @ low.T + negative @ neg_low.T <= score).all()


def test_only_survivors_of_the_bounds_are_scored():
    draw = np.random.default_rng(8)
    size = np.sort(draw.pareto(1.0, 4000))[:, None]  # few long vectors, many short ones
    values = np.minimum(size, 400) * draw.random((4000, 6))
    lists = exact_topk.SortedLists(np.arange(4000), values.astype(np.int64), np.float64)
    queries = draw.integers(1, 20, (40, 6))
    queries[::4] *= -1
    got = {}
    for q, places, scores in exact_topk.block_top(lists, np.arange(40) * 100, queries, 10):
        got[int(q[0])] = list(zip(lists.ids[places].tolist(), scores.astype(int).tolist()))
    for q in range(40):
        scores = values.astype(np.int64) @ queries[q]
        assert got[q] == [(i, -s) for s, i in sorted((-s, i) for i, s in enumerate(scores.tolist()) if i != 100 * q)[:10]]
    lists.resolved = 0
    list(exact_topk.block_top(lists, np.full(30, -1), np.abs(queries[1:4].repeat(10, 0)), 10))
    assert lists.resolved < 0.2 * 30 * 4000


def test_top_k_edges(spark):
    schema = "vec_id long, embedding array<double>, id string, v int, rank string, score string, q int, c int"
    rows = [(1, [1.0, 0.5]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, []), (None, [1.0, 1.0]), (6, [0.25]),
            (7, [0.5, 0.5]), (7, [0.5, 0.5]), (8, [float("inf"), 0.0])]
    table = spark.createDataFrame([(*r, "x", 1, "y", "z", 2, 3) for r in rows], schema)
    got = [tuple(r) for r in exact_topk.top_k(table, F.col("vec_id").isin(1, 5), k=3).orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 7, 64 * 32 + 32 * 32), (1, 2, 7, 64 * 32 + 32 * 32), (1, 3, 6, 64 * 16),
                   (5, 1, 1, 0), (5, 2, 6, 0), (5, 3, 7, 0)]
    empty = spark.createDataFrame([], schema)
    assert exact_topk.top_k(empty, F.col("vec_id") % 20 == 0).count() == 0


def test_chat_format_edges(spark):
    schema = "conv_id long, turn long, role string, text string, record string, id string, turns int"
    long = "</turn> \\###" * 60_000
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", long), (2, 0, None, None), (2, 0, None, None), (None, 0, "user", "x"),
            (3, None, "assistant", ""), (3, 5, "assistant", "b")]
    table = spark.createDataFrame([(*r, "r", "i", 1) for r in rows], schema).repartition(3)
    digest = lambda t: {r.conv_id: r for r in chat_format.digests(chat_format.formatted(
        chat_format.canonical(chat_format.as_records(t), "conv_id"), "conv_id"), "conv_id").collect()}
    got = digest(table)
    assert set(got) == {1, 2, 3, None} and [got[k].n_turns for k in (1, 2, 3, None)] == [2, 2, 2, 1]
    assert got[1].loss_chars == len(long) and got[1].loss_sha256 == hashlib.sha256(long.encode()).hexdigest()
    assert got[3].loss_sha256 == hashlib.sha256(b"b").hexdigest()
    assert digest(spark.createDataFrame([], schema)) == {}


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(4)
    first = np.array([0, 3, 3, 10, 140])
    score, chain = rng.normal(size=140), np.exp(rng.normal(size=(2, 2)))
    marginal, expected = toxic_crf.forward_backward(score, first, chain)
    for a, b in ((0, 3), (3, 10)):
        weights = {}
        for tags in itertools.product((0, 1), repeat=b - a):
            before = (0, *tags[:-1])
            weights[tags] = np.prod([chain[p, t] * np.exp(score[a + i] * t) for i, (p, t) in enumerate(zip(before, tags))])
        total = sum(weights.values())
        assert np.allclose(marginal[a:b], [sum(w for t, w in weights.items() if t[i]) / total for i in range(b - a)])
    state, forward = np.array([1.0, 0.0]), []
    for e in score[10:]:
        state = (state @ chain) * [1, np.exp(e)]
        state /= state.sum()
        forward.append(state)
    assert np.isclose(marginal[-1], forward[-1][1]) and np.isclose(expected.sum(), 140)


def test_toxic_words_are_found_with_their_places():
    draw = random.Random(5)
    words = [f"w{''.join(draw.choices('abcdefgh', k=6))}" for _ in range(300)]
    plain = [" ".join(draw.choices(words, k=60)) for _ in range(400)]
    toxic = [" ".join([*t.split()[:k], "vile", *t.split()[k:]]) for k, t in zip(itertools.cycle(range(60)), plain[:200])]
    sample = Sample([x for pair in zip(plain[200:], toxic) for x in pair], np.tile([0.0, 1.0], 200), 0.0, 0.0)
    order = np.random.default_rng(1).permutation(400)
    sample = Sample([sample.texts[i] for i in order], sample.labels[order], 0.0, 0.0)
    model = toxic_crf.fit(sample)
    scores, spans = toxic_crf.tagged(model, pa.array(["é vile wabc " + words[0], " ".join(words[:50]), None]), True)
    assert scores[0] > 0.5 > scores[1] and [(s["start"], s["end"]) for s in spans[0]] == [(2, 6)] and not spans[2]


def test_cnn_scores_do_not_depend_on_their_neighbours():
    model = byte_cnn.Model(np.random.default_rng(1).normal(size=(5, 256, 12)).astype(np.float32),
                           np.zeros(12, np.float32), np.random.default_rng(2).normal(size=25))
    texts = ["", None, "short", "x" * 10_000, "äöü " * 200]
    together = byte_cnn.document_scores(model, pa.array(texts))
    assert np.allclose(together, [byte_cnn.document_scores(model, pa.array([t], pa.string()))[0] for t in texts])


@pytest.mark.parametrize("name, label", [("op5_toxic_crf", "toxic"), ("op6_byte_cnn", "quality")])
def test_held_out_accuracy(spark, name, label):
    sf_dir = "/root/testdata/sf0.1"
    rows = queries.QUERIES[name](spark, sf_dir).where("held_out").join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    right, n = rows.agg(F.sum((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    assert right / n > 0.95


def test_language_of_held_out_documents(spark, sf_dir):
    rows = queries.op9_language_id(spark, sf_dir).where("held_out").join(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    right, n = rows.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.97


def test_letterless_texts_are_undetermined(edges):
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identified(edges, ["doc_id"]).collect()}
    assert all(got[k] == ("und", 0.0) for k in (1, 2, 3, 7)) and got[5][0] == "en"


def test_long_texts_count_every_ngram_once():
    text = "ab" * language_id.PIECE
    for order in language_id.ORDERS:
        owned = sum(int((high - low).sum()) for codes, starts, _ in language_id._pieces([text, "xyz"])
                    for _, low, high in [language_id._ngrams(codes, starts, order, 64)])
        assert owned == len(text) - order + 1 + 3 - order + 1


def small_model(texts):
    hashes = np.unique(np.concatenate([h for *_, h, _ in masked_lm._word_runs(pa.array(texts))]))
    model = masked_lm.blank_model()
    model.hashes, model.numbers = hashes[::2], np.arange(1, len(hashes[::2]) + 1)
    draw = np.random.default_rng(4)
    model.network.flat[:] = draw.normal(0, 0.3, len(model.network.flat))
    table = draw.random((256, 256))
    model.spelling = np.log(table / table.sum(1, keepdims=True))
    return model


def naive_log_probability(network, padded, place):
    h = np.tanh(network.bias + sum(network.embed[padded[place + o]] @ w for o, w in zip(masked_lm.OFFSETS, network.place)))
    h = np.append(h, 1)
    cls = np.exp(h @ network.classes)
    member = np.exp(np.stack([h @ m for m in network.members]))
    joint = (cls / cls.sum())[:, None] * member / member.sum(1, keepdims=True)
    assert np.isclose(joint.sum(), 1)
    target = padded[place] if padded[place] < joint.size else masked_lm.REST
    return np.log(joint.reshape(-1)[target])


def test_lm_scores_equal_brute_force(spark):
    text = "The quick brown fox jumps over the lazy dog Ünder " * 3
    model = small_model([text])
    padded, _, _ = next(masked_lm.padded_runs(model, pa.array([text])))
    at = masked_lm.positions_of(padded)
    assert 0 < (padded[at] >= 4096).sum() < len(at)
    total = sum(naive_log_probability(model.network, padded, place) for place in at)
    for word, number in zip(text.lower().split(), padded[at]):
        data = b" " + word.encode() + b" "
        total += 0 if number < 4096 else sum(model.spelling[a, b] for a, b in zip(data, data[1:]))
    got = masked_lm.scored(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string"), model, ["doc_id"])
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[1].n_tokens == 30 and np.isclose(rows[1].log_prob, total, rtol=1e-4) and rows[2].log_prob == 0


def test_lm_gradient_equals_differences():
    text = "a b c d a b x y z a b c " * 4
    model = small_model([text])
    padded, _, _ = next(masked_lm.padded_runs(model, pa.array([text, "b c"])))
    at, network = masked_lm.positions_of(padded), model.network
    loss = lambda flat: -np.mean([naive_log_probability(masked_lm.Network(flat), padded, p) for p in at])
    start, squares = network.flat.astype(float), masked_lm.Network(np.zeros_like(network.flat))
    assert masked_lm.train_step(network, squares, padded, 0.1) == len(at)
    draw, used = np.random.default_rng(5), np.flatnonzero(squares.flat > 1e-6)
    for k in draw.choice(used, 60, replace=False):
        step = np.zeros(len(start))
        step[k] = 1e-4
        slope = (loss(start + step) - loss(start - step)) / 2e-4
        assert np.isclose(abs(slope), np.sqrt(squares.flat[k]), rtol=0.02)
        assert np.sign(start[k] - network.flat[k]) == np.sign(slope)


def test_lm_trains_on_every_position_once():
    model = small_model(["a b c"])
    for padded, _, _ in masked_lm.padded_runs(model, pa.array(["a", None, "b c", LONG])):
        squares = masked_lm.Network(np.zeros_like(model.network.flat))
        step, room = masked_lm.STEP, 2 * masked_lm.SPAN
        used = sum(masked_lm.train_step(model.network, squares, padded[k:k + step + room], 0.1)
                   for k in range(0, len(padded) - room, step))
        assert used == len(masked_lm.positions_of(padded))


def test_lm_vocabulary_is_the_most_frequent_words(spark):
    texts = spark.createDataFrame([("b B a c",), ("a b",), (None,)], "text string").repartition(2)
    hashes, numbers = masked_lm.vocabulary(texts, size=2)
    want = np.concatenate([h for *_, h, _ in masked_lm._word_runs(pa.array(["b a"]))])
    assert dict(zip(hashes.tolist(), numbers.tolist())) == {int(want[0]): 1, int(want[1]): 2}


def test_lm_copies_are_added_in_a_tree(spark):
    rows = [(np.array([1.0, k]).tobytes(),) for k in range(200)]
    total = masked_lm._summed(spark.createDataFrame(rows, "sums binary").repartition(80), 80)
    assert [np.frombuffer(r["sums"]).tolist() for r in total.collect()] == [[200.0, 199 * 100.0]]


def test_lm_learns_from_the_corpus(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, after = (masked_lm.scored(documents, n, ["doc_id"]).agg(F.sum("log_prob")).first()[0]
                     for n in (masked_lm.blank_model(), masked_lm.train(documents)))
    assert after > before


def toxic_sample(order_seed, copies=False):
    """Half-random words; toxic texts hold one of a few marked words. Near copies differ in one word."""
    draw = random.Random(9)
    texts = []
    for k in range(900):
        words = ["".join("abcdefghij"[int(d)] for d in str(int(draw.paretovariate(0.7)) % 3000)) for _ in range(draw.randint(20, 80))]
        toxic = k % 8 == 0
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(["vileness", "scumbags", "worthless"])
        texts.append((" ".join(words), float(toxic)))
        if copies and k % 5 == 0:
            texts += [(" ".join([*words[:-1], "edit" + "abc"[c]]), float(toxic)) for c in range(3)]
    random.Random(order_seed).shuffle(texts)
    cut = len(texts) * 3 // 4
    y = np.array([t for _, t in texts[:cut]])
    prior = float(np.log((y.sum() + 0.5) / ((1 - y).sum() + 0.5)))
    return Sample([t for t, _ in texts[:cut]], y, prior, 0.0), texts[cut:]


@pytest.mark.parametrize("copies", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_toxic_fit_does_not_hang_on_the_order(seed, copies):
    sample, unseen = toxic_sample(seed, copies)
    model = toxic_crf.fit(sample)
    assert np.abs(model.total).max() < 100
    scores, _ = toxic_crf.tagged(model, pa.array([t for t, _ in unseen]), False)
    toxic = np.array([t for _, t in unseen]) == 1
    assert (scores[toxic] >= 0.5).mean() > 0.85 and (scores[~toxic] >= 0.5).mean() < 0.02


def test_near_copies_share_a_half():
    draw = random.Random(6)
    texts = []
    for _ in range(150):
        words = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
        texts += [" ".join(words[:k] + ["changed"] + words[k + 1:]) for k in (3, 30, 55)]
    half = toxic_crf.halves(pa.array(texts)).reshape(-1, 3)
    assert (half.min(1) == half.max(1)).mean() > 0.7 and 0.4 < half.mean() < 0.6
    common = toxic_crf.halves(pa.array(["the same start here " + t for t in texts] + ["", None]))
    assert 0.4 < common.mean() < 0.6


def test_total_weights_are_those_of_the_highest_likelihood():
    draw = np.random.default_rng(2)
    numbers = np.column_stack([np.ones(400), draw.normal(0, 40, 400), draw.random(400)])
    y = (numbers[:, 1] > 3).astype(float)  # separable: undamped steps run away
    weights = toxic_crf.fit_total(numbers, y, np.zeros(3))
    p = 1 / (1 + np.exp(-np.clip(numbers @ weights, -30, 30)))
    assert np.abs(numbers.T @ (y - p) - 0.05 * weights).max() < 1e-3


def test_sample_stays_below_its_characters(spark):
    documents = spark.createDataFrame([(k, "x" * 100 + str(k)) for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, toxic int")
    sample = training_sample(documents, labels, "toxic", class_chars=1000)
    assert sum(map(len, sample.texts)) <= 2000 and len(sample.texts) == 18


def test_pieces_are_forgotten_and_numbered_anew(monkeypatch):
    monkeypatch.setattr(byte_bpe, "RUN", 40)
    monkeypatch.setattr(byte_bpe, "KNOWN", 12)
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    draw = random.Random(1)
    texts = [" ".join(draw.choice(["alpha", "beta", "gamma", "déjà", "x1"]) + str(draw.randrange(9)) for _ in range(8)) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(texts)], ["kept", "t"])
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [row for b in byte_bpe._encoded(byte_bpe.pair_table(ranks), public_tokenizers.PATTERN, iter([batch])) for row in b.column(1).to_pylist()]
    assert ids == [own.encode_ordinary(t) for t in texts]


ITALIAN = "il gatto e la casa di mia nonna sono qui con noi per una lunga estate che non finisce mai nel mare"
JAPANESE = ["今日は", "天気がいいので", "散歩に", "行きます。", "明日は", "雨が", "降るでしょう", "電車で", "東京へ", "本を", "読むのが", "好きです"]


@pytest.fixture(scope="module")
def languages(spark, tmp_path_factory):
    """Ordinary texts of listed and other languages, with and without a language, and junk."""
    draw = random.Random(8)
    words = lambda some, n: " ".join(draw.choices(some, k=n))
    rows = []
    for name, common in quality_rules.COMMON_WORDS.items():
        rare = [f"{name}{''.join(draw.choices('abcdefghij', k=6))}" for _ in range(300)]
        rows += [(words(common.split() + rare, 150), name if k % 4 else None) for k in range(30)]
    rows += [(words(ITALIAN.split() + [f"parola{c}" for c in "abcdefgh"], 160), "it") for _ in range(30)]
    rows += [(words([a + b for a in JAPANESE for b in JAPANESE], 120), "ja") for _ in range(10)] + [(words(["12", "34"], 200), "xx"), ("", "yy"), (None, None)]
    rows += [(words(["zz### $$$"], 90) + f" {k}", lang) for k, lang in enumerate(["en", "it", None, "zz"])]
    rows = [(k, text, lang, "s", len(text or "")) for k, (text, lang) in enumerate(rows)]
    folder = tmp_path_factory.mktemp("languages")
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.coalesce(1).toPandas().to_parquet(folder / "documents.parquet")
    return str(folder), rows


def test_quality_of_every_language_agrees_with_sql(spark, languages):
    folder, rows = languages
    assert differences(queries.op2_quality_rules(spark, folder), connect(folder), oracle.SQL["op2_quality_rules"]) is None


def test_quality_keeps_ordinary_texts_of_other_languages(spark, languages):
    folder, rows = languages
    kept = {r["doc_id"]: r["kept"] for r in queries.op2_quality_rules(spark, folder).collect()}
    assert all(kept[k] for k, text, lang, *_ in rows if lang in ("it", "ja") and "###" not in text)
    assert all(kept[k] for k, text, lang, *_ in rows[:120])
    assert not any(kept[k] for k, text, *_ in rows if text and "###" in text)


def test_quality_columns_of_one_name_are_kept(spark):
    rows = spark.createDataFrame([(1, "a b", "en", "own", "mine")], "doc_id long, text string, lang string, words string, n_words string")
    assert quality_rules.measured(rows, ["words"], quality_rules.word_lists(rows)).first()["kept_columns"]["words"] == "own"


def test_windows_that_share_a_hash_are_compared(spark):
    draw = random.Random(4)
    rows = [(k, " ".join(draw.choice("abcd") for _ in range(draw.randint(0, 60)))) for k in range(80)]
    counted = spark.createDataFrame(rows, "k long, t string").withColumn(quality_rules.WORDS, F.split("t", " "))
    real = F.xxhash64
    quality_rules.F.xxhash64 = lambda *words: F.lit(1 << 40)  # every window shares one hash
    try:
        got = counted.select("k", quality_rules.repeated_window_words(F.col(quality_rules.WORDS)).alias("n"))
        got = {r["k"]: r["n"] for r in got.collect()}
    finally:
        quality_rules.F.xxhash64 = real
    for k, text in rows:
        words = text.split(" ")
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        hit = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        assert got[k] == len(hit)


def test_language_scores_equal_dictionary_counts(spark):
    draw = random.Random(3)
    texts = {"aa": "abcab", "bb": "bcdbe", "cc": "xyzab"}
    rows = [(k, " ".join("".join(draw.choices(texts[name], k=5)) for _ in range(6)), name)
            for k, name in enumerate(draw.choices(sorted(texts), k=90))]
    documents = spark.createDataFrame(rows + [(99, None, "aa"), (100, "abc", None)], "doc_id long, text string, lang string")
    buckets, counts, number = 64, {n: [0.5] * 64 for n in texts}, {n: 0 for n in texts}

    def grams(text):
        for order in language_id.ORDERS:
            for k in range(len(text) - order + 1):
                h = 0
                for j, c in enumerate(text[k:k + order]):
                    h = (h + ord(c)) * int(language_id._MIX[j]) % 2**32
                    h ^= h >> 15
                yield h % buckets

    for _, text, name in [*rows, (99, "", "aa")]:
        number[name] += 1
        for g in grams(text):
            counts[name][g] += 1
    want = {}
    for k, text, _ in rows:
        logs = {n: np.log(number[n] / sum(number.values())) + sum(np.log(counts[n][g] / sum(counts[n])) for g in grams(text)) for n in texts}
        best = max(sorted(logs), key=logs.get)
        want[k] = best, 1 / sum(np.exp(v - logs[best]) for v in logs.values())
    for block in (256, 2):  # in one block, and in two that pass on what they found
        language_id.BLOCK, before = block, language_id.BLOCK
        models = language_id.fit(documents, buckets=buckets)
        language_id.BLOCK = before
        assert len(models) == (1 if block > 3 else 2)
        got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(documents, models, ["doc_id"]).collect()}
        assert got[99] == ("und", 0.0) and len(got) == 92
        for k in want:
            assert got[k][0] == want[k][0] and np.isclose(got[k][1], want[k][1])


def test_number_signs_are_no_letters(spark):
    rows = [(1, "½ ² ①"), (2, "Ⅷ 12 _"), (3, "ª"), (4, "日"), (5, "12 a")]
    documents = spark.createDataFrame([(k, t, "en") for k, t in rows], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(documents, language_id.fit(documents), ["doc_id"]).collect()}
    assert got == {1: "und", 2: "und", 3: "en", 4: "en", 5: "en"}


def test_byte_network_equals_naive_convolution():
    draw = np.random.default_rng(7)
    model = byte_cnn.Model(draw.normal(0, 1, (byte_cnn.WIDTH, 256, byte_cnn.FILTERS)).astype(np.float32),
                           draw.normal(0, 1, byte_cnn.FILTERS).astype(np.float32), draw.normal(0, 0.1, 2 * byte_cnn.FILTERS + 1))
    texts = ["", None, "a", "déjà vu", *("".join(draw.choice(list("abc é\n"), n)) for n in (255, 256, 257, 448, 449, 1000))]
    want = []
    for text in texts:
        data, pooled = (text or "").encode(), []
        for begin in range(0, max(1, len(data) - byte_cnn.CHUNK + byte_cnn.STRIDE), byte_cnn.STRIDE):
            responses = []
            for at in range(begin, begin + byte_cnn.CHUNK):
                window = [data[at + k] if at + k < len(data) else 0 for k in range(byte_cnn.WIDTH)]
                responses.append(sum(model.tables[k][b].astype(float) for k, b in enumerate(window)) + model.bias)
            pooled.append(np.maximum(np.max(responses, 0), 0))
        features = np.concatenate([np.mean(pooled, 0), np.max(pooled, 0)])
        want.append(1 / (1 + np.exp(-(features @ model.out[:-1] + model.out[-1]))))
    assert np.allclose(byte_cnn.document_scores(model, pa.array(texts)), want, rtol=1e-4)


def test_layouts_become_the_same_turns(spark):
    records = [
        '{"messages":[{"role":"user","content":"a <b>"},{"role":"assistant","content":"\\\\l \\\\ </turn>"}]}',
        '{"conversations":[{"from":"human","value":"a <b>"},{"from":"gpt","value":"\\\\l \\\\ </turn>"}]}',
        '{"prompt":"a <b>","response":"\\\\l \\\\ </turn>"}', '{"data":{"question":"a <b>","answer":"\\\\l \\\\ </turn>"}}',
        '{"strange":1}', "no json", None, '{"messages":[]}',
    ]
    df = spark.createDataFrame(list(enumerate(records)), "id long, record string")
    turns = chat_format.canonical(df, "id")
    rows = {r.id: r for r in turns.collect()}
    want = [("user", "a <b>"), ("assistant", "\\l \\ </turn>")]
    assert all([tuple(t) for t in rows[k].turns] == want for k in range(4))
    assert all(rows[k].layout is None and rows[k].turns is None for k in (4, 5, 6)) and rows[7].turns == []
    text, mask = chat_format.render(want)
    assert chat_format.parse(text) == want and [chat_format.unescape(text[a:b]) for a, b in mask] == [want[1][1]]
    digests = {r.id: r for r in chat_format.digests(chat_format.formatted(turns, "id"), "id").collect()}
    assert digests[0].loss_sha256 == hashlib.sha256(want[1][1].encode()).hexdigest() and digests[4].n_turns is None


def test_word_hashes_see_whole_words_only():
    column = pa.array(["ab cd", None, "cd", "ab", "abc d" * 70_000])
    data, starts = bytewise.utf8(column)
    begin, end, first = bytewise.spans(data, starts, ~bytewise.IS_SPACE)
    hashes = bytewise.hash_spans(data, begin, end)
    assert list(np.diff(first)) == [2, 0, 1, 1, 70_001]
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2] and hashes[0] != hashes[1]


def test_a_role_that_holds_a_comma_is_one_turn(spark):
    rows = spark.createDataFrame([(1, 0, "user,assistant", "x"), (2, 1, "assistant", "b"), (2, 0, "user", "a")],
                                 "conv_id long, turn int, role string, text string")
    turns = chat_format.canonical(chat_format.as_records(rows), "conv_id")
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in turns.collect()}
    assert found == {1: [("user,assistant", "x")], 2: [("user", "a"), ("assistant", "b")]}


def test_a_repeated_id_gives_one_text_to_learn_from(spark, labels):
    documents = spark.createDataFrame([(i, f"text {k}") for i in range(50) for k in (i, i + 100)], "doc_id long, text string")
    sample = training_sample(documents, labels, "toxic")
    assert 0 < len(sample.texts) <= 50 and len(sample.texts) == len(set(sample.texts))
