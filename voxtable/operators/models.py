"""Tree classifiers and their cross-validation on Spark MLlib.

Training input: ``(<key>, features, label, split, fold)`` from ``assemble`` and ``hash_split``.
"""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def random_forest(**params) -> RandomForestClassifier:
    """20 trees of depth 5 unless overridden (H3)."""
    return RandomForestClassifier(**{"numTrees": 20, "maxDepth": 5, "seed": 42, **params})


def boosted_trees(**params) -> GBTClassifier:
    """20 boosting rounds with depth-5 trees unless overridden; binary labels only (H4)."""
    return GBTClassifier(**{"maxIter": 20, "maxDepth": 5, "seed": 42, **params})


def in_key_order(df: DataFrame, key: str, rows: int, rows_per_partition: int = 50_000) -> DataFrame:
    """Place rows by key, sorted within partitions.

    Trees bin and sample by partition. Here the placement depends on the keys and on the number
    of rows alone, so a model depends neither on how its input happened to be partitioned nor on
    the size of the cluster.
    """
    return df.repartition(-(-rows // rows_per_partition) or 1, key).sortWithinPartitions(key)


def auc_evaluator() -> BinaryClassificationEvaluator:
    """Area under ROC over every distinct score; the default would fold scores into 1000 bins."""
    return BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)


@dataclass
class CrossValidated:
    """Best parameters refitted on all training rows, and the mean score of every candidate.

    Scores are None where no fold could be scored.
    """

    model: Model
    scores: list[float | None]
    best: int
    folds_scored: int

    @property
    def best_score(self) -> float | None:
        return self.scores[self.best]


def cross_validate(
    train: DataFrame,
    estimator: Estimator,
    grid: list[dict] | None = None,
    evaluator=None,
    parallelism: int = 6,
) -> CrossValidated:
    """k-fold cross-validation over the ``fold`` column, then a refit on all rows (H5-H7).

    Folds are filters on a hashed column, which stays in the JVM. Tree training is a long chain
    of short jobs, so up to ``parallelism`` fits submit theirs at the same time; without a choice
    between candidates the refit is one of them. ``train`` should be persisted. An empty grid is
    plain cross-validation. A fold of one class has no area under the curve: it is left out of the
    mean, and ``folds_scored`` tells how many were not.
    """
    evaluator = evaluator or auc_evaluator()
    grid = grid or [{}]
    classes = F.count_distinct("label").alias("classes")
    folds = sorted(
        row.fold for row in train.groupBy("fold").agg(classes).collect() if row.classes > 1
    )

    def score(params: dict, fold: int) -> float:
        model = estimator.fit(train.where(F.col("fold") != fold), params)
        return evaluator.evaluate(model.transform(train.where(F.col("fold") == fold)))

    with_session = inheritable_thread_target(train.sparkSession)
    with ThreadPool(min(parallelism, len(grid) * len(folds) + 1)) as pool:
        refit = with_session(estimator.fit)
        only = pool.apply_async(refit, (train, grid[0])) if len(grid) == 1 else None
        runs = [[pool.apply_async(with_session(score), (p, f)) for f in folds] for p in grid]
        found = [[run.get() for run in of_candidate] for of_candidate in runs]
        scores = [sum(f) / len(f) if f else None for f in found]
        pick = max if evaluator.isLargerBetter() else min
        best = scores.index(pick(scores)) if folds else 0
        model = only.get() if only else estimator.fit(train, grid[best])
    return CrossValidated(model, scores, best, len(folds))


def cross_validate_all(
    train: DataFrame,
    estimators: dict[str, Estimator],
    parallelism: int = 6,
    grids: dict[str, list[dict]] | None = None,
) -> dict[str, CrossValidated]:
    """Cross-validate several models side by side on the same rows, each over its own grid (H6)."""
    grids = grids or {}

    def one(name: str) -> CrossValidated:
        return cross_validate(train, estimators[name], grids.get(name), parallelism=parallelism)

    with ThreadPool(len(estimators)) as pool:
        results = pool.map(inheritable_thread_target(train.sparkSession)(one), estimators)
    return dict(zip(estimators, results))


def score_rows(model: Model, rows: DataFrame, name: str) -> DataFrame:
    """Predictions tagged with the model's name, plus ``score``, the probability of class 1 (H8)."""
    return (
        model.transform(rows)
        .withColumn("model", F.lit(name))
        .withColumn("score", vector_to_array("probability")[1])
    )


def feature_importance(spark: SparkSession, model: Model, features: list[str]) -> DataFrame:
    """``(position, feature, importance)``, one row per feature (H9)."""
    weights = model.featureImportances.toArray()
    rows = [(i, f, float(w)) for i, (f, w) in enumerate(zip(features, weights))]
    return spark.createDataFrame(rows, "position int, feature string, importance double")


def cv_scores(spark: SparkSession, results: dict[str, CrossValidated]) -> DataFrame:
    """Best cross-validation score per model, and the folds that it is a mean of (H7)."""
    rows = [(name, r.best_score, r.folds_scored) for name, r in results.items()]
    return spark.createDataFrame(rows, "model string, cv_auc double, folds_scored int")
