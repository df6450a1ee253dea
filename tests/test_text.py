import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from review_pulse.functions import display, labels, lemma_rules, lexicon, text


def apply(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def expected_batch(value):
    value = re.sub(r"[^a-zA-Z\s]", "", value or "").lower()
    return re.sub(r"\s+", " ", value).strip()


def expected_stream(value):
    value = re.sub(r"[^a-z\s]", "", (value or "").lower())
    return re.sub(r"\s+", " ", value).strip()


WHITESPACE = [chr(c) for c in range(0x3001) if re.match(r"\s", chr(c))]
KELVIN, DOTTED_I, LONG_S = chr(0x212A), chr(0x130), chr(0x17F)
EDGE_TEXTS = [
    None, "", "123 !!", "Hello,\tWORLD\n", f"a{chr(0xA0)}b", KELVIN, DOTTED_I, "caf" + chr(0xE9), LONG_S,
    "don't  stop", " lead and trail ", f"a{chr(0x180E)}b", f"a{chr(0x200B)}b", f"x{chr(0)}y",
    chr(0x1F600) + " smile",
] + [f"a{c}b" for c in WHITESPACE]


def test_python_whitespace_is_complete():
    assert len(WHITESPACE) == 29


def test_clean_batch_edges(spark):
    assert apply(spark, EDGE_TEXTS, text.clean_batch) == [expected_batch(v) for v in EDGE_TEXTS]


def test_clean_stream_edges(spark):
    assert apply(spark, EDGE_TEXTS, text.clean_stream) == [expected_stream(v) for v in EDGE_TEXTS]


def test_stream_keeps_letters_that_lower_to_ascii(spark):
    assert apply(spark, [KELVIN, DOTTED_I], text.clean_stream) == ["k", "i"]
    assert apply(spark, [KELVIN, DOTTED_I], text.clean_batch) == ["", ""]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=60), min_size=1, max_size=40))
def test_clean_properties(spark, values):
    values = [v.encode("utf-8", "ignore").decode("utf-8") for v in values]
    once = apply(spark, values, text.clean_batch)
    assert once == [expected_batch(v) for v in values]
    assert once == apply(spark, once, text.clean_batch)
    assert all(re.fullmatch(r"[a-z ]*", v) for v in once)


def test_placeholder_matches_exactly_empty(spark):
    assert apply(spark, ["", " ", "x"], text.with_placeholder) == ["no text available", " ", "x"]


def test_cap_length(spark):
    long = "x" * 100_001
    assert [len(v) for v in apply(spark, ["ab", long], text.cap)] == [2, 100_000]


def test_tokens_and_ngrams_agree_with_mllib(spark):
    values = ["", "one", "one two", "one two three", "The cat sat on the mat", "a  b"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    staged = Tokenizer(inputCol="t", outputCol="words").transform(df)
    staged = StopWordsRemover(inputCol="words", outputCol="kept").transform(staged)
    for n in (2, 3):
        staged = NGram(n=n, inputCol="kept", outputCol=f"g{n}").transform(staged)
    native = staged.select(
        "*",
        text.tokens(F.col("t")).alias("native_words"),
        text.without_stop_words(F.col("words"), lexicon.STOP_WORDS).alias("native_kept"),
        text.ngrams(F.col("kept"), 2).alias("native_g2"),
        text.ngrams(F.col("kept"), 3).alias("native_g3"),
    )
    for row in native.collect():
        assert row.native_words == row.words
        assert row.native_kept == row.kept
        assert (row.native_g2, row.native_g3) == (row.g2, row.g3)
    assert apply(spark, [""], text.tokens) == [[""]]


def test_stop_words_are_those_of_mllib(spark):
    assert lexicon.STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
    assert "dont" in lexicon.CLEANED_STOP_WORDS and "well" not in lexicon.CLEANED_STOP_WORDS


@pytest.mark.parametrize("word, lemma", [
    ("running", "run"), ("loved", "love"), ("stories", "story"), ("boxes", "box"), ("glasses", "glass"),
    ("children", "child"), ("worked", "work"), ("creating", "create"), ("bus", "bus"), ("sing", "sing"),
    ("thing", "thing"), ("tried", "try"), ("falling", "fall"), ("bought", "buy"), ("dogs", "dog"),
    ("this", "this"), ("string", "string"), ("need", "need"),
])
def test_lemma_rules(spark, word, lemma):
    assert apply(spark, [word], lexicon.lemma) == [lemma]


def test_lemmatize_keeps_order_and_all_stop_word_texts(spark):
    got = apply(spark, ["the children were running to boxes", "this is it", "", "dont buy this"], lexicon.lemmatize)
    assert got == ["child run box", "this is it", "", "buy"]


def test_rating_labels(spark):
    values = ["5", "3", "2.9", "abc", None, "NaN", " 4 ", "5d", "0x1p3", "inf", "-1", "1e0", ".5", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, overall string")
    got = [r.label for r in labels.with_label(df).orderBy("i").collect()]
    assert got == [2, 1, 0, None, None, None, 2, None, None, 2, 0, 0, 0, None]
    numeric = spark.createDataFrame([(5.0,), (float("nan"),), (None,)], "overall double")
    assert [r.label for r in labels.with_label(numeric).collect()] == [2, None, None]
    assert labels.valid_labels(labels.with_label(df)).count() == 8


def test_sentiment_names(spark):
    assert apply(spark, [0, 1, 2, 3, None], labels.sentiment_name, "int") == [
        "Negative", "Neutral", "Positive", "Unknown", "Unknown"
    ]


def test_snippet_lengths(spark):
    got = apply(spark, ["x" * n for n in (199, 200, 201)], display.snippet)
    assert [len(v) for v in got] == [199, 200, 203] and got[2].endswith("x...")


def test_percent(spark):
    pairs = [(1, 16), (0, 0), (1, 3), (2, 3), (7, 7), (1, 8)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, n bigint, total bigint")
    got = [r[0] for r in df.orderBy("i").select(display.percent(F.col("n"), F.col("total"))).collect()]
    assert got == [6.3, 0.0, 33.3, 66.7, 100.0, 12.5]


def test_percent_is_within_half_a_tenth(spark):
    grid = spark.range(1, 200).alias("t").join(spark.range(0, 200).alias("n"), F.col("n.id") <= F.col("t.id"))
    off = grid.select(
        F.abs(display.percent(F.col("n.id"), F.col("t.id")) - F.col("n.id") * 100 / F.col("t.id")).alias("d")
    )
    assert off.agg(F.max("d")).first()[0] <= 0.0500001


def test_lemmas_are_learned_from_pairs(spark):
    pairs = spark.createDataFrame(
        [("walked", "walk"), ("talked", "talk"), ("red", "red"), ("stories", "story"), ("cities", "city"), ("went", "go"),
         ("dogs", "dog"), ("cats", "cat"), ("this", "this"), (None, "x"), ("", "")], "form string, lemma string")
    rules = lemma_rules.learn(pairs)
    lemma = lemma_rules.applier(rules, pairs)
    words = {"walked": "walk", "red": "red", "jumped": "jump", "parties": "party", "went": "go", "spent": "spent", "this": "this",
             "birds": "bird", "x": "x", "": ""}
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.transform(F.array("w"), lemma)[0].alias("l"))
    assert dict(map(tuple, rows.collect())) == words
    by_ending = {r.ending: (r.cut, r.added) for r in rules}
    assert by_ending["ies"] == (3, "y") and "ked" not in by_ending  # "ed" says the same
    with pytest.raises(ValueError):
        lemma_rules.learn(pairs, max_rules=2)
    none = lemma_rules.applier([], pairs)
    assert spark.createDataFrame([("walked",)], "w string").select(none(F.col("w"))).first()[0] == "walked"
