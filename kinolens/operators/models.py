"""Sentiment and genre classifiers on Spark ML.

Fits read one persisted feature frame. Multi-label targets have one model per
label; the fits are started from a small thread pool so that the cluster works
on several labels at a time, and scoring applies all of them in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.labels import DEPTH_PER_LABEL, LABELS_14, MAX_FEATURES, TREES_PER_LABEL
from kinolens.operators.aggregates import corpus_vocabulary, tf_vector, vocabulary_list
from kinolens.operators.metrics import binary_report, threshold_sweep
from kinolens.operators.tokens import review_to_words

SEED = 42


def to_matrix(df: DataFrame, features: str, target: str | None = None) -> DataFrame:
    """Array column to an ML vector, next to a label vector or class."""
    vector = array_to_vector(F.col(features).cast("array<double>")).alias("features")
    rest = [c for c in df.columns if c not in (features, target)]
    extra = [] if target is None else [F.col(target).alias("target")]
    return df.select(*rest, vector, *extra)


# ---- one binary model ----


def fit_forest(
    df: DataFrame, features: str = "features", target: str = "target", trees: int = 500, depth: int = 10,
    seed: int = SEED,
) -> RandomForestClassificationModel:
    """Random forest for a 0/1 target; persist ``df`` when features are costly."""
    forest = RandomForestClassifier(
        featuresCol=features, labelCol=target, numTrees=trees, maxDepth=depth, seed=seed,
    )
    return forest.fit(df.withColumn(target, F.col(target).cast("double")))


def predict(model: Model, df: DataFrame, key: str, target: str = "target") -> DataFrame:
    """id, prediction and actual."""
    return model.transform(df).select(
        F.col(key).alias("id"),
        F.col("prediction").cast("int").alias("prediction"),
        F.col(target).cast("int").alias("actual"),
    )


# ---- one model per label ----


def fit_per_label(
    df: DataFrame, labels: Sequence[str], target: str = "target", trees: Sequence[int] | int | None = None,
    depth: Sequence[int] | int | None = None, step: float = 0.1, seed: int = SEED, parallel: int = 4,
) -> dict[str, GBTClassificationModel]:
    """Boosted trees for every position of a 0/1 label vector.

    ``trees`` and ``depth`` are one number for all labels or one per label;
    without them the tuned values of the 14-label set apply.
    """
    trees = list(TREES_PER_LABEL) if trees is None else trees
    depth = list(DEPTH_PER_LABEL) if depth is None else depth
    trees = [trees] * len(labels) if isinstance(trees, int) else list(trees)
    depth = [depth] * len(labels) if isinstance(depth, int) else list(depth)
    if not len(labels) == len(trees) == len(depth):
        raise ValueError("give one number of trees and one depth per label")
    frame = df.where(F.col(target).isNotNull()).select("features", target).persist(StorageLevel.MEMORY_AND_DISK)

    def fit(i: int) -> GBTClassificationModel:
        booster = GBTClassifier(
            featuresCol="features", labelCol="y", maxIter=trees[i], maxDepth=depth[i], stepSize=step, seed=seed
        )
        y = F.get(F.col(target), F.lit(i)).cast("double").alias("y")
        return booster.fit(frame.select("features", y))

    try:
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            fitted = list(pool.map(fit, range(len(labels))))
    finally:
        frame.unpersist()
    return dict(zip(labels, fitted))


def fit_multilabel(
    df: DataFrame, labels: Sequence[str] = tuple(LABELS_14), target: str = "target", trees: int = 900,
    depth: int = 5, seed: int = SEED,
) -> dict[str, GBTClassificationModel]:
    """The same with shared parameters: one model against the rest per label."""
    return fit_per_label(df, labels, target, trees, depth, seed=seed)


def score_labels(models: dict[str, Model], df: DataFrame) -> DataFrame:
    """Adds ``p``: the probability of each label, in the order of ``models``.

    Models are applied one after another to the same row, so all labels are
    scored in one pass over the features.
    """
    scored, parts = df, []
    for i, model in enumerate(models.values()):
        out = model.copy()
        out.setProbabilityCol(f"__p{i}").setRawPredictionCol("").setPredictionCol("")
        scored = out.transform(scored)
        parts.append(F.get(vector_to_array(f"__p{i}"), F.lit(1)))
    return scored.select(*df.columns, F.array(*parts).alias("p"))


def predict_proba(
    models: dict[str, Model], df: DataFrame, key: str, target: str | None = "target"
) -> DataFrame:
    """Long probabilities: (id, label, p) and ``actual`` when there is a target."""
    names = list(models)
    scored = score_labels(models, df)
    cells = [
        F.struct(
            F.lit(name).alias("label"),
            F.get("p", F.lit(i)).alias("p"),
            *([] if target is None else [F.get(F.col(target), F.lit(i)).cast("int").alias("actual")]),
        )
        for i, name in enumerate(names)
    ]
    return scored.select(F.col(key).alias("id"), F.inline(F.array(*cells)))


def evaluate_saved_models(
    paths: dict[str, str], df: DataFrame, key: str, target: str = "target", cutoffs=(0.25, 0.3, 0.2, 0.1)
) -> DataFrame:
    """Reports of stored per-label models: each label and the whole matrix."""
    models = {name: GBTClassificationModel.load(path) for name, path in paths.items()}
    return threshold_sweep(predict_proba(models, df, key, target), cutoffs)


def grid_search(
    df: DataFrame, trees: Sequence[int], depths: Sequence[int], target: str = "target", folds: int = 3,
    seed: int = SEED, parallel: int = 4,
) -> CrossValidatorModel:
    """Cross-validated search over trees and depth by weighted F1."""
    booster = GBTClassifier(featuresCol="features", labelCol=target, seed=seed)
    grid = ParamGridBuilder().addGrid(booster.maxIter, list(trees)).addGrid(booster.maxDepth, list(depths)).build()
    search = CrossValidator(
        estimator=booster, estimatorParamMaps=grid, numFolds=folds, seed=seed, parallelism=parallel,
        evaluator=MulticlassClassificationEvaluator(labelCol=target, metricName="f1"),
    )
    return search.fit(df.withColumn(target, F.col(target).cast("double")))


def grid_results(search: CrossValidatorModel, spark) -> DataFrame:
    """(trees, depth, f1) of every point of a finished search."""
    rows = []
    for point, score in zip(search.getEstimatorParamMaps(), search.avgMetrics):
        named = {p.name: v for p, v in point.items()}
        rows.append((int(named["maxIter"]), int(named["maxDepth"]), float(score)))
    return spark.createDataFrame(rows, "trees int, depth int, f1 double")


# ---- whole flows ----


def bow_features(
    train: DataFrame, test: DataFrame, text: str, method: str = "letters", stem: bool = False, stop: bool = False,
    max_features: int = MAX_FEATURES,
) -> tuple[DataFrame, DataFrame]:
    """Count vectors of both sides over the vocabulary of the training side."""
    words = review_to_words(text, method, stem, stop)
    train, test = train.withColumn("words", words), test.withColumn("words", words)
    vocab = vocabulary_list(corpus_vocabulary(train, F.col("words"), max_features), max_features)
    return tf_vector(train, "words", vocab), tf_vector(test, "words", vocab)


def bow_flow(
    train: DataFrame, test: DataFrame, key: str, text: str, target: str, trees: int = 500, depth: int = 10,
    **features,
) -> DataFrame:
    """Clean, build the vocabulary, count, fit a forest and predict the hold-out."""
    train_x, test_x = bow_features(train, test, text, **features)
    train_x = train_x.select("features", target).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = fit_forest(train_x, target=target, trees=trees, depth=depth)
    finally:
        train_x.unpersist()
    return predict(model, test_x, key, target)


Featuriser = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def compare_methods(
    train: DataFrame, test: DataFrame, methods: dict[str, Featuriser], key: str, target: str, trees: int = 500,
    depth: int = 10,
) -> DataFrame:
    """One report row per featuriser, all on the same split and forest."""
    scored = None
    for name, featurise in methods.items():
        train_x, test_x = featurise(train, test)
        # A fit reads its input several times before the trees are grown.
        frame = train_x.select("features", target).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = fit_forest(frame, target=target, trees=trees, depth=depth)
        finally:
            frame.unpersist()
        rows = predict(model, test_x, key, target).withColumn("method", F.lit(name))
        scored = rows if scored is None else scored.unionByName(rows)
    return binary_report(scored, ["method"])
