"""Training, scoring, evaluating, saving and resolving sentiment models."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    LogisticRegressionModel,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, IndexToString, StringIndexerModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from review_pulse.functions.labels import valid_labels
from review_pulse.operators import features, metrics, sampling
from review_pulse.session import scratch_path
from review_pulse.sources.tables import fill_missing_text
from review_pulse.streaming.files import Files

# Training parameters per model family.
SVM_PARAMS = {"maxIter": 50, "regParam": 0.1}
LOGISTIC_PARAMS = {"maxIter": 20, "regParam": 0.1, "elasticNetParam": 0.5}

# How vectors lie in memory, without effect on what is learned: MLlib multiplies rows block by block, and an
# array of half a heap region (1 MB on heaps below 4 GB) or more takes whole regions that are never moved.
BLOCK_MB = 0.25
VECTORS_PER_BATCH = 64  # read from files at once

FAMILIES = ("svm", "logistic", "forest")


def wants_rebalancing(family: str) -> bool:
    """The logistic family weights the natural class mix instead."""
    return family != "logistic"


class StoredOneVsRest(OneVsRest):
    """One-vs-rest over rows that are stored: it reads them for each binary model, one model after the other.

    MLlib's own caches the features of all rows in memory, and every binary fit keeps blocks of them
    until it ends; side by side, three sets of blocks and that cache do not fit a small heap.
    """

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        label, binary = self.getLabelCol(), self.getClassifier()
        rows = dataset.select(label, self.getFeaturesCol())
        fitted = []
        for index in range(int(rows.agg(F.max(label)).first()[0]) + 1):
            own = f"mc2b${index}"
            one_class = rows.withColumn(own, F.when(F.col(label) == float(index), 1.0).otherwise(0.0))
            columns = {binary.labelCol: own, binary.featuresCol: self.getFeaturesCol(), binary.predictionCol: self.getPredictionCol()}
            fitted.append(binary.fit(one_class, columns))
        return self._copyValues(OneVsRestModel(models=fitted))


def _classifier(family: str, overrides: dict):
    columns = {"featuresCol": "features", "labelCol": "indexed_label"}
    if family == "svm":
        base = LinearSVC(**columns, maxBlockSizeInMB=BLOCK_MB, **{**SVM_PARAMS, **overrides})
        return StoredOneVsRest(classifier=base, **columns)
    if family == "logistic":
        return LogisticRegression(**columns, weightCol="weight", **{**LOGISTIC_PARAMS, **overrides})
    if family == "forest":
        # Without bootstrap draws, which go by partition, the same rows give the same trees in any layout.
        return RandomForestClassifier(**columns, seed=sampling.SPLIT_SEED, bootstrap=False, **overrides)
    raise ValueError(f"unknown model family {family!r}, expected one of {FAMILIES}")


def stages(family: str, **overrides) -> list:
    """Words to prediction. The weighted logistic model reads bigrams only."""
    if family == "logistic":
        return [
            *features.word_stages(), *features.bigram_tfidf_stages(),
            features.label_stage(order="frequencyDesc", on_unknown="skip"), _classifier(family, overrides),
        ]
    return [
        *features.word_stages(), *features.ngram_tfidf_stages(),
        features.label_stage(), _classifier(family, overrides),
    ]


def prepare(reviews: DataFrame) -> DataFrame:
    """Valid classes as double labels, no missing text."""
    labelled = valid_labels(reviews).withColumn("label", F.col("label").cast("double"))
    return fill_missing_text(labelled)


def training_splits(
    reviews: DataFrame, row_id: str = "review_id", order: str = "split_first", rebalance: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rebalanced training rows, and the held-out rows; both with ``split`` and ``copy``.

    ``split_first`` rebalances the training rows only, so no copy of a training row is evaluated;
    ``legacy`` rebalances everything and then splits copies independently. Without ``rebalance``
    the training rows are the rows of the split, one copy each.
    """
    prepared = prepare(reviews)
    is_train = F.col("split") == "train"
    if not rebalance:
        split = sampling.with_split(prepared, row_id).withColumn("copy", F.lit(1))
        return split.where(is_train), split.where(~is_train)
    if order == "legacy":
        balanced = sampling.rebalance(prepared, row_id)
        copy_id = F.concat_ws("#", F.col(row_id), F.col("copy").cast("string"))
        split = balanced.withColumn("split", sampling.split_name(copy_id))
        return split.where(is_train), split.where(~is_train)
    if order != "split_first":
        raise ValueError("order is 'split_first' or 'legacy'")
    split = sampling.with_split(prepared, row_id)
    return sampling.rebalance(split.where(is_train), row_id), split.where(~is_train).withColumn("copy", F.lit(1))


@contextmanager
def _kept(rows: DataFrame) -> Iterator[DataFrame]:
    """``rows``, computed once and read from disk by every pass inside the block.

    Vectors of all rows do not fit a heap, and blocks of them fragment it. As files of the shared folder,
    numbers that recur are encoded by a dictionary; a cluster without that folder keeps them on the
    executors' own disks.
    """
    spark = rows.sparkSession
    try:
        path = scratch_path(spark, "features")
    except RuntimeError:  # no shared folder
        rows.persist(StorageLevel.DISK_ONLY)
        try:
            yield rows
        finally:
            rows.unpersist()
        return
    try:
        rows.write.parquet(path)
        # A batch is decoded into one array for all its vectors; the setting stays in a session of its own.
        reader = spark.newSession()
        reader.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(VECTORS_PER_BATCH))
        yield reader.read.schema(rows.schema).parquet(path)
    finally:
        Files(spark, path).delete(path)


@contextmanager
def _encoded(train: DataFrame, front: list) -> Iterator[tuple[PipelineModel, DataFrame]]:
    """The fitted feature stages, and what the classifier reads.

    Everything up to the hashed counts works row by row and is done once; the counts, much smaller
    than the texts, are kept. Weights and label index are a few operations on each count, and are
    applied whenever the counts are read.
    """
    extra = [c for c in ("weight",) if c in train.columns]
    first = next(i for i, stage in enumerate(front) if isinstance(stage, IDF))
    hashing = Pipeline(stages=front[:first]).fit(train)
    with _kept(hashing.transform(train).select("tf", "label", *extra)) as counts:
        weighting = Pipeline(stages=front[first:]).fit(counts)
        encoded = weighting.transform(counts).select("features", "indexed_label", *extra)
        yield PipelineModel(stages=[*hashing.stages, *weighting.stages]), encoded


def _training_columns(train: DataFrame, family: str) -> DataFrame:
    if family == "logistic":
        return sampling.with_weights(train).select("lemmatized_text", "label", "weight")
    return train.select("lemmatized_text", "label")


def fit(train: DataFrame, family: str = "svm", partitions: int | None = None, **overrides) -> PipelineModel:
    """Fit all stages and add one that turns the class index back into the class code.

    ``partitions`` coalesces the encoded rows for the optimiser's many short jobs.
    """
    *front, classifier = stages(family, **overrides)
    with _encoded(_training_columns(train, family), front) as (encoder, encoded):
        fitted = classifier.fit(encoded if partitions is None else encoded.coalesce(partitions))
    return _assembled(encoder, fitted)


def _assembled(encoder: PipelineModel, classifier) -> PipelineModel:
    indexer = next(s for s in encoder.stages if isinstance(s, StringIndexerModel))
    # Reviews to be scored carry a dummy label that the training rows may lack.
    indexer.setHandleInvalid("keep")
    back = IndexToString(inputCol="prediction", outputCol="predicted_class", labels=indexer.labels)
    return PipelineModel(stages=[*encoder.stages, classifier, back])


def score(model: PipelineModel, reviews: DataFrame) -> DataFrame:
    """Add ``predicted_label``; a dummy label is supplied where the rows have none."""
    if "label" not in reviews.columns:
        reviews = reviews.withColumn("label", F.lit(0.0))
    scored = model.transform(reviews)
    return scored.withColumn("predicted_label", F.col("predicted_class").cast("double").cast("int"))


@dataclass(frozen=True)
class Evaluation:
    confusion: DataFrame
    per_class: DataFrame
    overall: DataFrame


def evaluate(scored: DataFrame, *by: str) -> Evaluation:
    """Confusion table and the metrics derived from it, one set per value of ``by``."""
    pairs = scored.withColumn("predicted", F.col("predicted_label").cast("double"))
    confusion = metrics.confusion_matrix(pairs, *by, prediction="predicted")
    return Evaluation(confusion, metrics.per_class(confusion, *by), metrics.overall(confusion, *by))


def train_and_evaluate(
    reviews: DataFrame, family: str = "svm", order: str = "split_first", **overrides
) -> tuple[PipelineModel, Evaluation]:
    """Fit on the training split and evaluate the other two."""
    train, held_out = training_splits(reviews, order=order, rebalance=wants_rebalancing(family))
    model = fit(train, family, **overrides)
    return model, evaluate(score(model, held_out), "split")


def grid_search(train: DataFrame, family: str = "logistic", reg_params=(0.01, 0.1), folds: int = 3):
    """Cross-validated choice of the regularisation; features are fitted once, outside the folds."""
    if family != "logistic":
        raise ValueError("the grid is defined for the logistic model")
    *front, classifier = stages(family)
    grid = ParamGridBuilder().addGrid(classifier.regParam, list(reg_params)).build()
    with _encoded(_training_columns(train, family), front) as (encoder, encoded):
        search = CrossValidator(
            estimator=classifier,
            estimatorParamMaps=grid,
            evaluator=MulticlassClassificationEvaluator(labelCol="indexed_label", metricName="f1"),
            numFolds=folds,
            seed=sampling.SPLIT_SEED,
            parallelism=len(grid),
        )
        found = search.fit(encoded)
    return _assembled(encoder, found.bestModel), [
        (reg, float(f1)) for reg, f1 in zip(reg_params, found.avgMetrics)
    ]


def evaluator_metrics(scored: DataFrame, code: float) -> list[float]:
    """Precision, recall and F1 of one class by MLlib's evaluator, over ``label`` and ``prediction``."""
    judge = MulticlassClassificationEvaluator(labelCol="label", metricLabel=code)
    return [judge.evaluate(scored, {judge.metricName: name})
            for name in ("precisionByLabel", "recallByLabel", "fMeasureByLabel")]


def logistic_stage(model: PipelineModel) -> LogisticRegressionModel:
    return next(s for s in model.stages if isinstance(s, LogisticRegressionModel))


def logistic_margins(model: PipelineModel) -> tuple[list[list[float]], list[float], list[str]]:
    """Coefficients by feature, intercept and class name of each margin."""
    fitted = logistic_stage(model)
    names = next(s for s in model.stages if isinstance(s, IndexToString)).getLabels()
    return (fitted.coefficientMatrix.toArray().tolist(), fitted.interceptVector.toArray().tolist(),
            list(names)[: fitted.numClasses])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def stored_models(spark: SparkSession, base: str) -> list[str]:
    """Sorted names of the models saved below ``base``, on any file system Spark can read."""
    try:
        metadata = spark.read.format("binaryFile").load(f"{base.rstrip('/')}/*/metadata/part-*")
    except AnalysisException:  # no such path
        return []
    name = F.regexp_extract("path", r"([^/]+)/metadata/[^/]+$", 1)
    return [row.name for row in metadata.select(name.alias("name")).distinct().orderBy("name").collect()]


def resolve(spark: SparkSession, base: str, name: str | None = None) -> tuple[str, PipelineModel]:
    """Load the named model, or with a warning the first by name when it is absent; fail when there is none."""
    names = stored_models(spark, base)
    if not names:
        raise FileNotFoundError(f"no models below {base}")
    chosen = name if name in names else names[0]
    if name is not None and chosen != name:
        warnings.warn(f"no model {name!r} below {base}, using {chosen!r}", stacklevel=2)
    return chosen, PipelineModel.load(f"{base.rstrip('/')}/{chosen}")
