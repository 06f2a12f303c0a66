"""Sentiment classifiers and the grid over their settings."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.constants import MAX_TERMS, SPLIT_SEED
from echoloom.functions.labels import decode_label, encode_label
from echoloom.functions.text import normalize_for_scoring
from echoloom.operators.boosting import GRADIENT, NEWTON, BoostedTrees
from echoloom.operators.evaluate import eval_metrics
from echoloom.operators.features import tfidf_model
from echoloom.operators.forest import RandomForest
from echoloom.operators.pairwise import OneVsOneSVM
from echoloom.operators.runs import FINISHED

DEEPEST_TREE = 30  # used where no depth limit is asked for
PACKED_ROWS = 20_000  # of a task in each of the many short passes of a regression


# --- estimators --------------------------------------------------------------


def logistic_regression(rows: int, C: float = 1.0, max_iter: int = 1000) -> Estimator:
    """Multinomial regression; ``C`` is the inverse penalty on the summed loss."""
    return LogisticRegression(
        family="multinomial",
        maxIter=max_iter,
        tol=1e-4,
        regParam=1.0 / (C * max(rows, 1)),
        elasticNetParam=0.0,
        standardization=False,
    )


def random_forest(rows: int, n_estimators: int = 100, max_depth: int | None = None) -> Estimator:
    """Trees on drawn rows, every cut chosen among the root of all features."""
    return RandomForest(
        trees=n_estimators,
        depth=DEEPEST_TREE if max_depth is None else max_depth,
        seed=SPLIT_SEED,
    )


def gradient_boosting(
    rows: int, n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3
) -> Estimator:
    """Boosted trees on the shared softmax, one tree for each label and round."""
    return BoostedTrees(kind=GRADIENT, rounds=n_estimators, rate=learning_rate, depth=max_depth)


def linear_svm(rows: int, max_iter: int = 1000, C: float = 0.0) -> Estimator:
    """A linear machine for each pair of labels, with a vote; without ``C`` no penalty."""
    return OneVsOneSVM(C=C, maxIter=max_iter)


def deep_boosting(rows: int, n_estimators: int = 100, learning_rate: float = 0.3) -> Estimator:
    """Second-order boosted trees with the defaults of the second boosting family."""
    return BoostedTrees(kind=NEWTON, rounds=n_estimators, rate=learning_rate, depth=6)


FAMILIES: dict[str, Callable[..., Estimator]] = {
    "LogisticRegression": logistic_regression,
    "RandomForest": random_forest,
    "GradientBoosting": gradient_boosting,
    "LinearSVM": linear_svm,
    "DeepBoosting": deep_boosting,
}

# The ten variants of the grid.
GRID: dict[str, list[dict]] = {
    "LogisticRegression": [
        {"C": 0.01, "max_iter": 1000},
        {"C": 0.1, "max_iter": 1000},
        {"C": 1.0, "max_iter": 1000},
        {"C": 10.0, "max_iter": 1000},
    ],
    "RandomForest": [
        {"n_estimators": 50, "max_depth": None},
        {"n_estimators": 100, "max_depth": None},
        {"n_estimators": 100, "max_depth": 10},
    ],
    "GradientBoosting": [
        {"learning_rate": 0.01, "n_estimators": 100},
        {"learning_rate": 0.1, "n_estimators": 100},
        {"learning_rate": 0.5, "n_estimators": 100},
    ],
}

# The settings that all variants share and every run records.
SHARED = {"vectorizer": "TF-IDF", "max_features": MAX_TERMS, "ngram_range": "(1,2)"}


# --- training and scoring ----------------------------------------------------


@dataclass
class TrainedModel:
    """One fitted variant with its run record."""

    run: dict
    model: PipelineModel = field(repr=False)


def with_label(reviews: DataFrame) -> DataFrame:
    """Rows with text and a known label, the label encoded as double."""
    return (
        reviews.na.drop(subset=["content", "sentiment"])
        .withColumn("label", encode_label(F.col("sentiment")).cast("double"))
        .filter(F.col("label").isNotNull())
    )


def score(model: PipelineModel, reviews: DataFrame) -> DataFrame:
    """All input columns plus ``predicted_sentiment``."""
    scored = model.transform(reviews)
    extra = [c for c in scored.columns if c not in reviews.columns]
    return scored.withColumn("predicted_sentiment", decode_label(F.col("prediction"))).drop(*extra)


def _fit(family: str, features: DataFrame, rows: int, params: Mapping):
    if family == "LogisticRegression":
        # Starting a task and adding up its gradient takes longer than going through a small file's rows.
        cores = features.sparkSession.sparkContext.defaultParallelism
        features = features.coalesce(max(cores, -(-rows // PACKED_ROWS)))
    return FAMILIES[family](rows, **params).fit(features)


def train_one(train: DataFrame, family: str, **params) -> PipelineModel:
    """Fit TF-IDF and one classifier on labelled reviews."""
    labelled = with_label(train)
    tfidf = tfidf_model(labelled)
    features = tfidf.transform(labelled).select("label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = _fit(family, features, features.count(), params)
    finally:
        features.unpersist()
    return PipelineModel([*tfidf.stages, fitted])


def grid_search(
    train: DataFrame,
    test: DataFrame,
    grid: Mapping[str, Sequence[dict]] = GRID,
    batch_id: str | None = None,
    parallelism: int = 3,
) -> list[TrainedModel]:
    """Fit every variant on the same features and score it on the same test rows.

    TF-IDF is fitted once and its output kept on memory and disk.  Variants run
    side by side as separate Spark jobs; only metrics reach the driver.
    """
    batch = batch_id or uuid.uuid4().hex
    labelled, held_out = with_label(train), with_label(test)
    tfidf = tfidf_model(labelled)
    keep = StorageLevel.MEMORY_AND_DISK
    features = tfidf.transform(labelled).select("label", "features").persist(keep)
    probe = tfidf.transform(held_out).select("label", "features").persist(keep)
    rows = features.count()

    def fit(variant: tuple[str, int, dict]) -> TrainedModel:
        family, number, params = variant
        fitted = _fit(family, features, rows, params)
        outcome = fitted.transform(probe).select(
            F.col("label").cast("int").alias("actual"),
            F.col("prediction").cast("int").alias("predicted"),
        )
        metrics = eval_metrics(
            outcome, labels=(0, 1, 2), actual="actual", predicted="predicted"
        ).first()
        run = {
            "batch_id": batch,
            "run_id": f"{batch}-{family}-{number}",
            "model": family,
            "status": FINISHED,
            "params": {k: str(v) for k, v in {**SHARED, **params}.items()},
            **metrics.asDict(),
        }
        return TrainedModel(run, PipelineModel([*tfidf.stages, fitted]))

    variants = [
        (family, number, params)
        for family, settings in grid.items()
        for number, params in enumerate(settings)
    ]
    pool = ThreadPool(min(parallelism, len(variants)))
    try:
        return pool.map(inheritable_thread_target(train.sparkSession)(fit), variants)
    finally:
        pool.close()
        features.unpersist()
        probe.unpersist()


def predict_batch(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Actual beside predicted sentiment for every test row."""
    return score(model, test).select(
        "review_id", "content", F.col("sentiment").alias("actual_sentiment"), "predicted_sentiment"
    )


def score_reviews(model: PipelineModel, reviews: DataFrame, normalize: bool = False) -> DataFrame:
    """Sentiment of every review, the text kept as it was.

    ``normalize`` scores the lower-case text without links, digits and
    punctuation; the default scores the text the model was trained on.
    """
    text = F.coalesce(F.col("content"), F.lit(""))
    prepared = reviews.withColumn("_review", F.col("content")).withColumn(
        "content", normalize_for_scoring(text) if normalize else text
    )
    return (
        score(model, prepared)
        .withColumn("content", F.col("_review"))
        .withColumnRenamed("predicted_sentiment", "sentiment")
        .drop("_review")
    )
