"""Named queries over the benchmark tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from review_pulse import schemas
from review_pulse.functions import display, labels, lemma_rules, lexicon, text
from review_pulse.operators import features, marts, metrics, models, profile, sampling, threshold
from review_pulse.plans import jobs, views
from review_pulse.session import scratch_path
from review_pulse.sources import file_index, messages, tables
from review_pulse.streaming import late, rates, refresh, scoring, trend, versions
from review_pulse.streaming.files import Files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The product asked for in the lookups, and one that no table holds.
KNOWN_ASIN = "42"
UNKNOWN_ASIN = "no-such-product"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, for comparison across engines."""
    return df.select(*[
        F.round(name, digits).alias(name) if kind == "double" else F.col(name) for name, kind in df.dtypes
    ])


# --- dashboard marts -------------------------------------------------------------------------


@query
def sentiment_trend(spark, sf_dir):
    predictions = views.predictions(spark, sf_dir)
    return marts.sentiment_trend(predictions, marts.latest_moment(predictions))


@query
def sentiment_counts(spark, sf_dir):
    return marts.sentiment_counts(views.predictions(spark, sf_dir))


@query
def sentiment_share(spark, sf_dir):
    return marts.sentiment_share(views.predictions(spark, sf_dir))


@query
def top_reviewers(spark, sf_dir):
    return marts.top_reviewers(views.predictions(spark, sf_dir))


@query
def top_products(spark, sf_dir):
    return marts.top_products(views.predictions(spark, sf_dir))


def _daily_partials(spark: SparkSession, sf_dir: str, key: Column) -> DataFrame:
    rows = views.predictions(spark, sf_dir).withColumns({"key": key, "part": F.to_date(marts.MOMENT)})
    return marts.with_prediction(rows).groupBy("part", "key").agg(*marts.class_tallies(), F.count("*").alias("total"))


@query
def top_by_threshold(spark, sf_dir):
    """Top reviewers, and top keys of a skewed column, from daily counts without summing every key."""
    def top(name: str, key: Column) -> DataFrame:
        found = threshold.top_keys(_daily_partials(spark, sf_dir, key), "key", "part")
        return found.select(F.lit(name).alias("keys"), "key", "negative", "neutral", "positive", "total")

    skewed = F.concat(F.lit("k"), F.floor(F.log2(F.col("reviewer_id").cast("int") + 1) * 4).cast("string"))
    return top("reviewers", F.col("reviewer_id")).unionByName(top("skewed", skewed))


@query
def product_lookup(spark, sf_dir):
    return marts.product_sentiment(views.predictions(spark, sf_dir), KNOWN_ASIN)


@query
def product_lookup_missing(spark, sf_dir):
    return marts.product_sentiment(views.predictions(spark, sf_dir), UNKNOWN_ASIN)


@query
def recent_reviews(spark, sf_dir):
    return marts.recent_reviews(
        views.predictions(spark, sf_dir), lookup=lambda ids: views.texts_of(spark, sf_dir, ids))


@query
def indexed_lookup(spark, sf_dir):
    """The documents of the newest and of the oldest reviews, out of a table of many files, by its side table."""
    stored, side = scratch_path(spark, "documents"), scratch_path(spark, "file-index")
    views.documents(spark, sf_dir).repartition(24, "doc_id").write.parquet(stored)
    file_index.build(spark, stored, "doc_id", side)
    scored = marts.with_prediction(views.predictions(spark, sf_dir))
    ends = [marts.newest(scored, 10), scored.orderBy(marts.MOMENT, "review_id").limit(10)]
    ids = [int(r["review_id"]) for end in ends for r in end.select("review_id").collect()]
    found = file_index.read_ids(spark, stored, "doc_id", side, ids)
    return found.select("doc_id", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query
def store_stats(spark, sf_dir):
    return marts.store_stats(views.predictions(spark, sf_dir))


@query
def latest_prediction(spark, sf_dir):
    latest = marts.latest_prediction(views.predictions(spark, sf_dir))
    return latest.select(F.date_format("latest", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("latest"))


# --- text ------------------------------------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.documents(spark, sf_dir).select("doc_id", "text")


@query
def clean_text_batch(spark, sf_dir):
    cleaned = text.clean_batch(F.col("text")).alias("cleaned_text")
    return _documents(spark, sf_dir).select("doc_id", cleaned)


@query
def clean_text_stream(spark, sf_dir):
    cleaned = text.clean_stream(F.col("text")).alias("cleaned_text")
    return _documents(spark, sf_dir).select("doc_id", cleaned)


@query
def text_placeholder(spark, sf_dir):
    """Product codes have no letters, so they clean to nothing; event types stay."""
    rows = views.ratings(spark, sf_dir)
    raw = F.when(F.col("event_type") == "error", F.col("asin")).otherwise(F.col("event_type"))
    return rows.select("review_id", text.with_placeholder(text.clean_batch(raw)).alias("cleaned_text"))


@query
def empty_text_audit(spark, sf_dir):
    return profile.empty_text_audit(clean_text_batch(spark, sf_dir))


@query
def text_cap(spark, sf_dir):
    capped = text.cap(F.col("text"))
    return _documents(spark, sf_dir).select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.length(capped).cast("bigint").alias("n_capped"),
        F.md5(capped).alias("capped_md5"),
    )


@query
def text_preview(spark, sf_dir):
    return messages.message_previews(messages.decode(views.payloads(spark, sf_dir)))


@query
def text_snippets(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", display.snippet(F.col("text")).alias("snippet"))


@query
def lexicon_lemmas(spark, sf_dir):
    cleaned = text.with_placeholder(text.clean_batch(F.col("text"))).alias("cleaned_text")
    rows = _documents(spark, sf_dir).select("doc_id", cleaned)
    return rows.select("doc_id", lexicon.lemmatize(F.col("cleaned_text")).alias("lemmatized_text"))


# Forms and their lemmas to learn endings from.
LEMMA_PAIRS = (
    "walked walk,talked talk,reading read,eating eat,singing sing,houses house,dogs dog,cats cat,tables table,"
    "stories story,cities city,running run,making make,taken take,went go,children child,better good,thing thing,"
    "bring bring,king king,red red,need need,this this,was be,is be,nations nation,motion motion,quickly quickly"
)


def lemma_pairs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(pair.split()) for pair in LEMMA_PAIRS.split(",")], "form string, lemma string")


@query
def learned_lemmas(spark, sf_dir):
    """Distinct words of all documents, and their lemmas by the rules learned from the pairs."""
    lemma = lemma_rules.applier(lemma_rules.learn(lemma_pairs(spark)), lemma_pairs(spark))
    words = text.cleaned_words(text.clean_batch(F.col("text")))
    distinct = _documents(spark, sf_dir).select(F.explode(F.array_distinct(words)).alias("word")).distinct()
    lemmas = F.transform(F.array("word"), lemma)[0]
    return distinct.select("word", lemmas.alias("lemma"))


# --- labels and profile ----------------------------------------------------------------------


@query
def document_preview(spark, sf_dir):
    return profile.preview(views.documents(spark, sf_dir).select("doc_id", "source", "text"), "doc_id")


@query
def rating_labels(spark, sf_dir):
    return views.ratings(spark, sf_dir).select("review_id", "overall", "label")


@query
def rating_labels_dirty(spark, sf_dir):
    """Ratings as text of mixed quality; rows without a usable rating are dropped."""
    dirty = (
        F.when(F.col("event_type") == "error", F.col("props"))
        .when(F.col("event_type") == "signup", F.lit("NaN"))
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), F.col("overall").cast("int").cast("string")))
        .when(F.col("event_type") == "purchase", F.concat(F.col("overall").cast("string"), F.lit("e0")))
    )
    rows = views.ratings(spark, sf_dir).select("review_id", dirty.alias("rating_text"))
    return labels.valid_labels(labels.with_label(rows, "rating_text"))


@query
def rating_summary(spark, sf_dir):
    return _rounded(profile.rating_summary(views.ratings(spark, sf_dir)))


@query
def value_quartiles(spark, sf_dir):
    """The summary of a column in which nearly every value is another one."""
    rows = views.table(spark, sf_dir, "events").select((F.col("value") + F.col("event_id") / 3.0).alias("measure"))
    return _rounded(profile.rating_summary(rows, "measure"))


@query
def rating_histogram(spark, sf_dir):
    return profile.histogram(views.ratings(spark, sf_dir))


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(views.predictions(spark, sf_dir))


@query
def class_distribution(spark, sf_dir):
    return profile.class_distribution(views.ratings(spark, sf_dir))


@query
def class_weights(spark, sf_dir):
    return _rounded(sampling.class_weights(views.ratings(spark, sf_dir)))


@query
def weighted_rows(spark, sf_dir):
    rows = views.ratings(spark, sf_dir).select("review_id", "label")
    return _rounded(sampling.with_weights(rows).select("review_id", "label", "weight"))


# --- rebalancing and splitting ---------------------------------------------------------------


def _rebalanced(spark: SparkSession, sf_dir: str, exact: bool) -> DataFrame:
    rows = views.ratings(spark, sf_dir).select("review_id", "label")
    return sampling.rebalance(rows, "review_id", exact=exact).select("review_id", "label", "copy")


@query
def rebalance_exact(spark, sf_dir):
    return _rebalanced(spark, sf_dir, exact=True)


@query
def rebalance_hash(spark, sf_dir):
    return _rebalanced(spark, sf_dir, exact=False)


def _lopsided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only one-star ratings negative, so that the positive class has to be thinned out."""
    stars = F.col("overall")
    label = F.when(stars <= 1, labels.NEGATIVE).when(stars <= 3, labels.NEUTRAL).otherwise(labels.POSITIVE)
    return views.ratings(spark, sf_dir).select("review_id", label.alias("label"))


@query
def downsample_exact(spark, sf_dir):
    return sampling.rebalance(_lopsided(spark, sf_dir), "review_id", exact=True)


@query
def downsample_hash(spark, sf_dir):
    return sampling.rebalance(_lopsided(spark, sf_dir), "review_id")


@query
def rebalance_without_negatives(spark, sf_dir):
    """No negative rows to go by: every positive row stays, the neutral ones are repeated."""
    rows = views.ratings(spark, sf_dir).where(F.col("label") != labels.NEGATIVE).select("review_id", "label")
    return sampling.rebalance(rows, "review_id", exact=True)


@query
def shuffled_head(spark, sf_dir):
    """The first rows of the reproducible random order."""
    rows = views.ratings(spark, sf_dir).select("review_id", "label")
    return sampling.shuffled(rows, "review_id").limit(100)


@query
def split_rows(spark, sf_dir):
    return sampling.with_split(views.ratings(spark, sf_dir).select("review_id", "label"), "review_id")


@query
def split_sizes(spark, sf_dir):
    return split_rows(spark, sf_dir).groupBy("split").agg(F.count("*").alias("n"))


@query
def split_by_class(spark, sf_dir):
    return split_rows(spark, sf_dir).groupBy("split", "label").agg(F.count("*").alias("n"))


@query
def training_rows(spark, sf_dir):
    """Split first, then only the training rows rebalanced: rows per split and class."""
    reviews = views.ratings(spark, sf_dir).select("review_id", "label", F.col("asin").alias("lemmatized_text"))
    train, held_out = models.training_splits(reviews)
    return train.unionByName(held_out).groupBy("split", F.col("label").cast("int").alias("label")).agg(F.count("*").alias("n"))


@query
def training_mix(spark, sf_dir):
    """The training report's class counts: before, after rebalancing, and of the rows held out."""
    reviews = views.ratings(spark, sf_dir).select("review_id", "label", F.col("asin").alias("lemmatized_text"))
    return jobs.class_mix(reviews, *models.training_splits(reviews))


# --- features --------------------------------------------------------------------------------


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their cleaned words, before and after stop-word removal."""
    words = text.cleaned_words(text.clean_batch(F.col("text")))
    return _documents(spark, sf_dir).select("doc_id", words.alias("words")).withColumn(
        "filtered_words", text.without_stop_words(F.col("words"), lexicon.STOP_WORDS)
    )


def _listed(words: Column, name: str) -> list[Column]:
    return [F.size(words).cast("bigint").alias(f"n_{name}"), F.array_join(words, "|").alias(name)]


@query
def tokens(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", *_listed(F.col("words"), "words"))


@query
def stopwords_removed(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", *_listed(F.col("filtered_words"), "words"))


@query
def bigrams(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", *_listed(text.ngrams(F.col("filtered_words"), 2), "bigrams"))


@query
def trigrams(spark, sf_dir):
    return _words(spark, sf_dir).select("doc_id", *_listed(text.ngrams(F.col("filtered_words"), 3), "trigrams"))


@query
def idf_terms(spark, sf_dir):
    return _rounded(features.idf_terms(_words(spark, sf_dir), "filtered_words"))


@query
def vocab_tfidf(spark, sf_dir):
    return _rounded(features.vocab_tfidf(_words(spark, sf_dir), "doc_id", "words"))


@query
def hashed_features(spark, sf_dir):
    """Hashed words, bigrams and trigrams per document: their number, and sums over their buckets."""
    terms = features.hashed_terms(_words(spark, sf_dir), "doc_id", "filtered_words")
    sums = []
    for space, name in enumerate(("words", "bigrams", "trigrams")):
        bucket = F.when(F.col("space") == space, F.col("bucket").cast("bigint"))
        sums += [F.count(bucket).alias(f"n_{name}"), F.coalesce(F.sum(bucket), F.lit(0)).alias(f"{name}_sum"),
                 F.coalesce(F.sum(bucket * bucket), F.lit(0)).alias(f"{name}_squares")]
    return terms.groupBy("doc_id").agg(*sums)


@query
def hashed_buckets(spark, sf_dir):
    """Every bucket of the hashed words of every document, with its count."""
    counts = features.hashed_counts(_words(spark, sf_dir), "doc_id", "filtered_words")
    return counts.where(F.col("space") == 0).select("doc_id", "bucket", "n")


@query
def label_index_freq(spark, sf_dir):
    return features.label_index_frequency(views.ratings(spark, sf_dir))


@query
def label_index_alpha(spark, sf_dir):
    return features.label_index_alphabetical(views.ratings(spark, sf_dir))


# --- metrics ---------------------------------------------------------------------------------


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(views.predictions(spark, sf_dir), prediction="predicted_label")


@query
def confusion_matrix(spark, sf_dir):
    return _confusion(spark, sf_dir)


@query
def confusion_display(spark, sf_dir):
    shown = metrics.confusion_pivot(_confusion(spark, sf_dir), list(labels.CLASS_CODES))
    names = {str(code): f"predicted_{name.lower()}" for code, name in labels.CLASS_NAMES.items()}
    return shown.withColumnsRenamed(names)


@query
def prediction_distribution(spark, sf_dir):
    return metrics.prediction_distribution(views.predictions(spark, sf_dir), "predicted_label")


@query
def per_class_metrics(spark, sf_dir):
    return _rounded(metrics.per_class(_confusion(spark, sf_dir)))


@query
def overall_metrics(spark, sf_dir):
    return _rounded(metrics.overall(_confusion(spark, sf_dir)))


# --- models ----------------------------------------------------------------------------------


def stored_rows(rows: DataFrame, path: str) -> DataFrame:
    """Rows written once and read by every later pass."""
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


MODEL_COLUMNS = ("review_id", "lemmatized_text", "label")


def _fitted(spark: SparkSession, sf_dir: str, family: str):
    """A model fitted on the training split, and the other rows; texts are curated once for both.

    Only the columns that fitting and scoring read are stored: the raw and the cleaned text would
    add two more copies of every text to the disk and to each pass.
    """
    curated = stored_rows(views.curated(spark, sf_dir).select(*MODEL_COLUMNS), scratch_path(spark, "curated"))
    train, held_out = models.training_splits(curated, rebalance=models.wants_rebalancing(family))
    return models.fit(train, family), held_out


def _reloaded_agrees(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    """Every held-out row, and whether the model, stored and loaded back by name, scores it alike."""
    fitted, held_out = _fitted(spark, sf_dir, family)
    base = scratch_path(spark, "models")
    models.save(fitted, f"{base}/{family}")
    expected = models.score(fitted, held_out).select(
        "review_id", "split", "label", "lemmatized_text", F.col("predicted_label").alias("expected"))
    found = models.score(models.resolve(spark, base, family)[1], expected)
    agrees = F.col("predicted_label").eqNullSafe(F.col("expected")).alias("agrees")
    return found.select("review_id", "split", "label", agrees)


@query
def svm_scores(spark, sf_dir):
    return _reloaded_agrees(spark, sf_dir, "svm")


@query
def logistic_scores(spark, sf_dir):
    """Every held-out row, and whether its class is the one with the largest margin.

    Margins are summed inside the row, from the non-zero features and the model's coefficients, lists
    as long as the feature space.
    """
    model, held_out = _fitted(spark, sf_dir, "logistic")
    coefficients, intercepts, names = models.logistic_margins(model)
    entries = features.nonzero(F.col("features"))
    margins = F.transform(F.array(entries), lambda row: F.array(*[
        F.aggregate(row, F.lit(b), lambda s, e: s + e["value"] * F.get(F.lit(weights), e["index"]))
        for weights, b in zip(coefficients, intercepts)]))[0]
    classes = F.array(*[F.lit(int(float(name))) for name in names])
    scored = models.score(model, held_out).select("review_id", "split", "label", "predicted_label", margins.alias("margins"))
    largest = F.element_at(classes, F.array_position("margins", F.array_max("margins")).cast("int"))
    return scored.select("review_id", "split", "label", F.col("predicted_label").eqNullSafe(largest).alias("agrees"))


@query
def forest_scores(spark, sf_dir):
    return _reloaded_agrees(spark, sf_dir, "forest")


@query
def model_metrics(spark, sf_dir):
    """Rows per split and class, and whether the metrics are those of MLlib's evaluator."""
    model, held_out = _fitted(spark, sf_dir, "svm")
    pairs = models.score(model, held_out).select("split", "label", F.col("predicted_label").cast("double").alias("prediction"))
    scored = stored_rows(pairs, scratch_path(spark, "scored"))
    found = models.evaluate(scored.withColumn("predicted_label", F.col("prediction").cast("int")), "split").per_class
    reference = spark.createDataFrame(
        [(split, code, *models.evaluator_metrics(scored.where(F.col("split") == split), code))
         for split in ("validation", "test") for code in map(float, labels.CLASS_CODES)],
        "split string, class double, p double, r double, f double")
    agrees = F.lit(True)
    for ours, theirs in (("precision", "p"), ("recall", "r"), ("f1", "f")):
        agrees = agrees & (F.abs(F.col(ours) - F.col(theirs)) < 1e-9)
    return found.join(reference, ["split", "class"], "left").select(
        "split", "class", "actual", F.coalesce(agrees, F.lit(False)).alias("agrees"))


@query
def grid_search(spark, sf_dir):
    """The values tried, the rows learned from, and whether the best score's value was chosen."""
    train, _ = models.training_splits(views.curated(spark, sf_dir), rebalance=False)
    model, scores = models.grid_search(train, folds=2)
    chosen = dict(scores)[models.logistic_stage(model).getRegParam()]
    rows = train.count()
    return spark.createDataFrame(
        [(reg, rows, 0 < f1 <= 1, chosen == max(f for _, f in scores)) for reg, f1 in scores],
        "reg_param double, train_rows long, valid boolean, best_chosen boolean")


# --- messages, files -------------------------------------------------------------------------


@query
def json_roundtrip(spark, sf_dir):
    decoded = messages.accepted(messages.decode(messages.encode(views.all_reviews(spark, sf_dir))))
    return decoded.select(
        "review_id", F.col("reviewerID").alias("reviewer_id"), "asin",
        F.col("reviewTime").alias("review_time"), F.col("overall").cast("double").alias("overall"),
        F.col("reviewText").alias("review_text"),
    )


@query
def json_quarantine(spark, sf_dir):
    refused = messages.quarantined(messages.decode(views.payloads(spark, sf_dir)))
    return refused.select(F.col(schemas.CORRUPT).alias("value"))


@query
def ingest_stats(spark, sf_dir):
    return messages.ingest_stats(messages.decode(views.payloads(spark, sf_dir)))


@query
def published_lines(spark, sf_dir):
    path = scratch_path(spark, "published")
    messages.publish(views.all_reviews(spark, sf_dir), path=path)
    return tables.line_count(spark, path)


@query
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    tables.write_csv(views.all_curated(spark, sf_dir).select(*schemas.CURATED_CSV.names), path)
    return tables.fill_missing_text(tables.read_csv(spark, path)).select(
        "review_id", "reviewer_id", "asin", "review_time", "overall", "cleaned_text", "lemmatized_text", "label"
    )


@query
def jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    tables.write_json_lines(views.all_reviews(spark, sf_dir).select(*messages.message_columns()), path)
    return tables.read_reviews(spark, path).select(
        "review_id", F.col("reviewerID").alias("reviewer_id"), "asin", "overall",
        F.col("reviewTime").alias("review_time"), F.col("reviewText").alias("review_text"),
    )


# --- streams ---------------------------------------------------------------------------------

ONE_PASS = {"availableNow": True}


@query
def stream_scored(spark, sf_dir):
    """Reviews published as messages and scored in micro-batches: does each get its batch score?"""
    model, _ = _fitted(spark, sf_dir, "svm")
    scorer = scoring.model_scorer(model)
    source, target, checkpoint = (scratch_path(spark, n) for n in ("messages", "predictions", "checkpoint"))
    messages.publish(views.all_reviews(spark, sf_dir), path=source)
    stream = messages.read_stream(spark, path=source, maxFilesPerTrigger="2")
    scored = scoring.score_stream(stream, scorer, target, checkpoint, trigger=ONE_PASS)
    scoring.await_all([scored])
    at_once = scorer(scoring.preprocess(messages.decode(spark.read.text(source)))).select(
        "review_id", F.col("predicted_label").alias("expected"))
    agrees = F.col("predicted_label").eqNullSafe(F.col("expected")).alias("agrees")
    return tables.read_predictions(spark, target).join(at_once, "review_id", "left").select("review_id", "asin", agrees)


def _length_model(shift: int) -> PipelineModel:
    """A stored model whose class is known: the length of the text, shifted, modulo three."""
    return PipelineModel(stages=[SQLTransformer(
        statement=f"SELECT *, CAST((length(lemmatized_text) + {shift}) % 3 AS STRING) AS predicted_class FROM __THIS__")])


@query
def stream_model_change(spark, sf_dir):
    """Two versions in one stream: messages of the second half of the month find another model in use."""
    base, target, checkpoint = (scratch_path(spark, n) for n in ("models", "predictions", "checkpoint"))
    for name, shift in (("first", 0), ("second", 1)):
        models.save(_length_model(shift), f"{base}/{name}")
    entries = iter(["first", "second"])

    def start(stream: DataFrame) -> StreamingQuery:
        versions.put_into_use(spark, base, next(entries))
        return scoring.score_stream(stream, versions.scorer(base, target), target, checkpoint, versioned=True, trigger=ONE_PASS)

    rows = messages.encode(views.all_reviews(spark, sf_dir))
    day = F.dayofmonth(F.to_date(F.get_json_object("value", "$.reviewTime")))
    _in_waves(rows, F.when(day <= 15, 0).otherwise(1), 2, start)
    scored = tables.read_predictions(spark, target).join(F.broadcast(versions.records(spark, target)), ["stream", "batch_id"])
    return scored.select("review_id", "predicted_label", "model")


def _payload_stream(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Messages of mixed quality through the scoring stream: stored rows and quarantined originals.

    The star rating stands in for a model, so that the outcome is known.
    """
    source, target, refused, checkpoint = (
        scratch_path(spark, n) for n in ("messages", "predictions", "quarantine", "checkpoint")
    )
    views.payloads(spark, sf_dir).write.text(source)
    scored = scoring.score_stream(
        messages.read_stream(spark, path=source, maxFilesPerTrigger="2"),
        lambda rows: rows.withColumn("predicted_label", labels.rating_label(F.col("overall"))),
        target, checkpoint, quarantine=refused, trigger=ONE_PASS,
    )
    scoring.await_all([scored])
    return tables.read_predictions(spark, target), spark.read.parquet(refused)


@query
def stream_stored(spark, sf_dir):
    stored, _ = _payload_stream(spark, sf_dir)
    return stored.select("review_id", "reviewer_id", "asin", "review_time", "lemmatized_text", "predicted_label")


@query
def stream_batch_times(spark, sf_dir):
    """The time a batch is stored at: one for all its rows, later for later batches."""
    stored, _ = _payload_stream(spark, sf_dir)
    times = stored.groupBy("batch_id").agg(
        F.count("*").alias("n"), F.count_distinct("ingestion_time").alias("times"), F.max("ingestion_time").alias("at"))
    rising = F.array_sort(F.collect_list(F.struct("batch_id", "at")))
    return times.agg(
        F.sum("n").alias("stored"), F.every(F.col("times") == 1).alias("one_time_each"),
        F.every(F.col("at").isNotNull()).alias("always_known"),
        (F.transform(rising, lambda r: r["at"]) == F.array_sort(F.collect_list("at"))).alias("rising"))


@query
def stream_side_by_side(spark, sf_dir):
    """Two queries over the same messages at once, one with lemmas: both end, and each stores every message."""
    source = scratch_path(spark, "messages")
    views.payloads(spark, sf_dir).where(F.col("value").isNotNull()).write.text(source)
    rated = lambda rows: rows.withColumn("predicted_label", labels.rating_label(F.col("overall")))
    targets, queries = {}, []
    for name, normalise in (("cleaned", text.clean_stream), ("lemmas", scoring.lemmatized)):
        targets[name], checkpoint = scratch_path(spark, "predictions"), scratch_path(spark, "checkpoint")
        stream = messages.read_stream(spark, path=source, maxFilesPerTrigger="4")
        queries.append(scoring.score_stream(stream, rated, targets[name], checkpoint, normalise=normalise, trigger=ONE_PASS))
    scoring.await_all(queries)
    counts = [tables.read_predictions(spark, target).agg(
        F.lit(name).alias("query"), F.count("*").alias("stored"), F.count("predicted_label").alias("scored"),
        F.count_distinct("review_id").alias("reviews")) for name, target in targets.items()]
    return counts[0].unionByName(counts[1])


@query
def stream_generated_ids(spark, sf_dir):
    """Messages without an id: those that differ in any field get different ones."""
    source, target, checkpoint = (scratch_path(spark, n) for n in ("messages", "predictions", "checkpoint"))
    rows = views.all_reviews(spark, sf_dir).withColumn("review_id", F.lit(None).cast("string"))
    messages.publish(rows, path=source)
    rated = lambda decoded: decoded.withColumn("predicted_label", labels.rating_label(F.col("overall")))
    scoring.await_all([scoring.score_stream(messages.read_stream(spark, path=source), rated, target, checkpoint, trigger=ONE_PASS)])
    return tables.read_predictions(spark, target).agg(
        F.count("*").alias("stored"), F.count("review_id").alias("with_id"), F.count_distinct("review_id").alias("ids"))


@query
def stream_quarantine(spark, sf_dir):
    _, refused = _payload_stream(spark, sf_dir)
    return refused.select("value")


def _files_stream(rows: DataFrame, files_per_batch: int) -> DataFrame:
    """Rows as a stream of files, so many files per micro-batch."""
    spark, source = rows.sparkSession, scratch_path(rows.sparkSession, "replay")
    rows.write.parquet(source)
    schema = spark.read.parquet(source).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)


def _in_waves(rows: DataFrame, wave: Column, waves: int, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Rows as a stream that is started anew for every wave of them and goes on from its checkpoint."""
    spark, source = rows.sparkSession, scratch_path(rows.sparkSession, "waves")
    numbered = rows.withColumn("wave", wave)
    for number in range(waves):
        numbered.where(F.col("wave") == number).select(*rows.columns).write.mode("append").parquet(source)
        scoring.await_all([start(spark.readStream.schema(rows.schema).parquet(source))])


def _late_waves(spark: SparkSession, sf_dir: str, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Predictions in four waves: ten days of the month each, and a thirteenth of the rows one wave later."""
    tenth = F.floor((F.dayofmonth("ingestion_time") - 1) / 10)
    wave = F.least(tenth + (F.col("review_id").cast("bigint") % 13 == 0).cast("int"), F.lit(3))
    _in_waves(views.predictions(spark, sf_dir), wave, 4, start)


@query
def stream_trend(spark, sf_dir):
    """The continuous trend: rows of days that the watermark has closed are not counted."""
    target, checkpoint = scratch_path(spark, "trend"), scratch_path(spark, "checkpoint")
    _late_waves(spark, sf_dir, lambda stream: trend.start(stream, target, checkpoint, trigger=ONE_PASS, fan=2))
    return trend.current(spark, target).withColumn("day", display.display_day(F.col("day")))


CORRECTED: dict[tuple[str, str], str] = {}


def _corrected(spark: SparkSession, sf_dir: str) -> str:
    """One run of the correcting trend for both of its queries."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in CORRECTED or not Files(spark, CORRECTED[key]).exists(CORRECTED[key]):
        target, checkpoint = scratch_path(spark, "corrected"), scratch_path(spark, "checkpoint")
        _late_waves(spark, sf_dir, lambda stream: late.start(stream, target, checkpoint, salts=4, trigger=ONE_PASS, fan=2))
        CORRECTED[key] = target
    return CORRECTED[key]


@query
def ingest_rate(spark, sf_dir):
    """Messages per window of twelve hours that begin every six, with the rate of accepted ones."""
    target, checkpoint = scratch_path(spark, "rates"), scratch_path(spark, "checkpoint")
    rows = views.payloads(spark, sf_dir, "ts").withColumnRenamed("ts", rates.ARRIVED)
    _in_waves(rows, F.floor((F.dayofmonth(rates.ARRIVED) - 1) / 15), 2, lambda stream: rates.start(
        stream, target, checkpoint, "12 hours", "6 hours", "1 hour", ONE_PASS, fan=2))
    found = rates.rates(spark, target).withColumns({"start": display.display_time(F.col("start")), "end": display.display_time(F.col("end"))})
    return _rounded(found)


@query
def stream_late(spark, sf_dir):
    """Rows more than a day behind the newest row of earlier batches."""
    found = late.late_rows(spark, _corrected(spark, sf_dir))
    return found.select("review_id", "predicted_label", F.to_date("ingestion_time").alias("day"))


@query
def stream_late_trend(spark, sf_dir):
    """The trend with late rows counted after all, and which days can change only by late rows."""
    return late.trend(spark, _corrected(spark, sf_dir))


def _land(spark: SparkSession, sf_dir: str, fan: int | None) -> tuple[str, str]:
    """Predictions with their texts stored by a stream that refreshes the marts after every batch."""
    target, mart_path, checkpoint = (scratch_path(spark, n) for n in ("landed", "marts", "checkpoint"))
    texts = views.documents(spark, sf_dir).select(F.col("doc_id").alias("event_id"), "text")
    rows = views.predictions(spark, sf_dir, "event_id").join(texts, "event_id", "left").drop("event_id")

    def as_stored(batch: DataFrame) -> DataFrame:
        stored = batch.withColumns({
            "lemmatized_text": text.clean_stream(F.col("text")),
            "review_time": F.date_format("ingestion_time", "yyyy-MM-dd"),
            "ingestion_time": F.col("ingestion_time").cast("timestamp"),
        })
        return stored.select(*schemas.PREDICTIONS.names)

    running = scoring.land(
        _files_stream(rows.repartition(8, "review_id"), 2), as_stored, target, checkpoint,
        after_batch=refresh.refresh(target, mart_path, fan), trigger=ONE_PASS,
    )
    scoring.await_all([running])
    return target, mart_path


LANDED: dict[tuple[str, str], tuple[str, str]] = {}


def _landed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """One landing for all mart queries of an application; some of its batches are merged, some are not."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in LANDED or not Files(spark, LANDED[key][0]).exists(LANDED[key][0]):
        LANDED[key] = _land(spark, sf_dir, fan=3)
    target, mart_path = LANDED[key]
    return tables.read_predictions(spark, target), mart_path


@query
def stream_mart_refresh(spark, sf_dir):
    stored, mart_path = _landed(spark, sf_dir)
    return refresh.sentiment_trend(spark, stored, mart_path, marts.latest_moment(stored))


@query
def stream_mart_counts(spark, sf_dir):
    _, mart_path = _landed(spark, sf_dir)
    return refresh.sentiment_counts(spark, mart_path)


@query
def stream_mart_reviewers(spark, sf_dir):
    _, mart_path = _landed(spark, sf_dir)
    return refresh.top_reviewers(spark, mart_path)


@query
def stream_mart_products(spark, sf_dir):
    _, mart_path = _landed(spark, sf_dir)
    return refresh.top_products(spark, mart_path)


@query
def stream_mart_recent(spark, sf_dir):
    _, mart_path = _landed(spark, sf_dir)
    return refresh.recent_reviews(spark, mart_path)


@query
def stream_mart_stats(spark, sf_dir):
    _, mart_path = _landed(spark, sf_dir)
    return refresh.store_stats(spark, mart_path)


@query
def stream_landed(spark, sf_dir):
    """The rows of the landing itself, read from merged and single batches."""
    stored, _ = _landed(spark, sf_dir)
    return stored.select("review_id", "reviewer_id", "asin", "review_time", "predicted_label", "text", "lemmatized_text", "ingest_date")


@query
def stream_mart_merged(spark, sf_dir):
    """Rows stored and class counts before a merge, after it, after a merged batch came again, and after
    the old folders were deleted."""
    target, mart_path = _land(spark, sf_dir, fan=None)
    states = []

    def look(state: str) -> None:
        stored = tables.read_predictions(spark, target).count()
        counts = refresh.sentiment_counts(spark, mart_path).select("label", "reviews").collect()
        states.extend((state, stored, r["label"], r["reviews"]) for r in counts)

    look("before")
    first = tables.read_predictions(spark, target).agg(F.min_by(F.struct("stream", "batch_id"), "batch_id").alias("b")).first()["b"]
    folder = scoring.batch_path(target, first["stream"], first["batch_id"])
    kept = stored_rows(tables.read_batch(spark, target, folder).select(*schemas.PREDICTIONS.names), scratch_path(spark, "kept"))
    tables.merge_predictions(spark, target, everything=True)
    refresh.merge_marts(spark, mart_path, everything=True)
    look("merged")
    scoring.write_batch(kept, first["stream"], first["batch_id"], target)
    refresh.refresh(target, mart_path)(spark, first["stream"], first["batch_id"])
    look("replayed")
    refresh.vacuum(spark, target, mart_path, keep=1)
    look("vacuumed")
    return spark.createDataFrame(states, "state string, stored long, label int, reviews long")
