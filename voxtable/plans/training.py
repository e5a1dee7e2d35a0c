"""Train, compare and export two tree classifiers on a clean feature table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.functions.scalars import numeric_columns
from voxtable.operators import evaluate, models, prepare
from voxtable.schemas import CLASS_NAMES
from voxtable.sources.tables import cached, materialize, work_tables, write_csv

# The published model names.
RANDOM_FOREST, BOOSTED_TREES = "Random Forest", "GBT"


def training_frame(
    df: DataFrame, key: str, features: list[str], label: Column, seed: int = 42
) -> DataFrame:
    """Assembled rows with split and fold, placed by key so that models are reproducible.

    The needed columns are written once: training passes over them many times, and neither a
    lost executor nor the filters on missing features should compute them again.
    """
    stored = materialize(df.select(key, *features, label.alias("label")))
    assembled = prepare.assemble(stored, features, F.col("label"), carry=(key,))
    split = prepare.hash_split(assembled, key, seed=seed)
    return models.in_key_order(split, key, stored.count())


@contextmanager
def train_and_compare(
    clean: DataFrame,
    key: str = "volume_id",
    label: str = "grade",
    features: list[str] | None = None,
    estimators: dict[str, Estimator] | None = None,
    names: tuple[str, ...] = CLASS_NAMES,
    parallelism: int = 6,
    grids: dict[str, list[dict]] | None = None,
    seed: int = 42,
) -> Iterator[dict[str, DataFrame]]:
    """Result tables by name.

    All models, two unless others are given, are cross-validated on the training rows, each over
    its grid if it has one, and judged on the hold-out rows. ``dropped_rows`` tells how many rows
    had no label or a missing feature and took no part. The training frame and the scored hold-out
    rows stay cached inside the ``with`` block, at whose end the tables written on the way go.
    """
    spark = clean.sparkSession
    features = features or numeric_columns(clean, exclude=(key, label))
    estimators = estimators or {
        RANDOM_FOREST: models.random_forest(),
        BOOSTED_TREES: models.boosted_trees(),
    }
    label_of = F.col(label)
    with work_tables(spark), cached(training_frame(clean, key, features, label_of, seed)) as frame:
        train = frame.where(F.col("split") == "train")
        test = frame.where(F.col("split") == "test")
        fitted = models.cross_validate_all(train, estimators, parallelism, grids)
        predictions = [models.score_rows(r.model, test, name) for name, r in fitted.items()]
        columns = [key, "model", "label", "prediction", "score", "probability"]
        everything = reduce(DataFrame.unionByName, [p.select(columns) for p in predictions])
        with cached(everything) as scored:
            metrics = evaluate.metrics_long(evaluate.all_metrics(scored))
            tables = {
                "cv_scores": models.cv_scores(spark, fitted),
                "model_comparison": metrics,
                "model_winner": evaluate.best_models(metrics, list(fitted)),
                "dropped_rows": prepare.assemble_report(clean, features, F.col(label)),
                "class_distribution": prepare.class_distribution(frame, names=names),
                "confusion_matrices": evaluate.confusion_matrix(scored, names, by=("model",)),
            }
            for name, result in fitted.items():
                short = name.lower().replace(" ", "_")
                own = scored.where(F.col("model") == name)
                weights = models.feature_importance(spark, result.model, features)
                tables[f"{short}_feature_importance"] = evaluate.rank_importance(weights)
                tables[f"{short}_predictions"] = evaluate.prediction_table(own, key, names)
            yield tables


def export(tables: dict[str, DataFrame], folder: str) -> None:
    """Write each table as CSV to ``<folder>/<name>``.

    Predictions grow with the data and keep their partitions; the others are single small files.
    """
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}", single_file=not name.endswith("_predictions"))
