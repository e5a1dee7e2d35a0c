"""Evaluation tables of scored rows ``(label, prediction, score)``, optionally per model.

Everything but the ROC area is a function of the counts per (label, prediction), so the scored
rows are read once and reduced to a handful of rows before any formula is applied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxtable.functions.scalars import decode_label, long_rows
from voxtable.operators.ordered import area_under_roc
from voxtable.schemas import CLASS_NAMES

# The published metric names.
METRICS = ("accuracy", "auc", "precision", "recall", "f1")


def confusion_matrix(
    scored: DataFrame, names: tuple[str, ...] = CLASS_NAMES, by: tuple[str, ...] = ()
) -> DataFrame:
    """Every (actual, predicted) cell incl. zeros, long form.

    A label or prediction that is none of 0..len(names)-1 raises instead of vanishing.
    """
    label, prediction = F.col("label").cast("double"), F.col("prediction").cast("double")
    classes = range(len(names))
    cells = [(a, p) for a in classes for p in classes]
    wide = scored.groupBy(*by).agg(
        *[
            F.count_if((label == float(a)) & (prediction == float(p))).alias(f"cell_{a}_{p}")
            for a, p in cells
        ],
        F.count("*").alias("total"),
    )
    counted = sum((F.col(f"cell_{a}_{p}") for a, p in cells), F.lit(0))
    guard = F.when(counted == F.col("total"), F.lit(0)).otherwise(
        F.raise_error(F.lit("label or prediction outside the named classes")).cast("int")
    )
    rows = [
        (F.lit(names[a]), F.lit(names[p]), F.col(f"cell_{a}_{p}") + guard) for a, p in cells
    ]
    return wide.select(*by, long_rows(rows, ["actual", "predicted", "count"]))


def class_metrics(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """accuracy, weighted precision, recall and f1 (D27); one row per group.

    Classes are those that occur as labels, each weighted by its share of the rows. A class that
    is never predicted has precision 0.
    """
    counts = scored.groupBy(
        *by, F.col("label").cast("double"), F.col("prediction").cast("double")
    ).agg(F.count("*").alias("n"))
    hit, none = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0), F.lit(0)
    sides = counts.select(
        *by,
        long_rows(
            [
                (F.col("label"), F.col("n"), none, hit),
                (F.col("prediction"), none, F.col("n"), none),
            ],
            ["class", "actual", "predicted", "correct"],
        ),
    )
    classes = (
        sides.groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "correct")])
        .where(F.col("actual") > 0)
    )
    precision = F.coalesce(F.try_divide("correct", "predicted"), F.lit(0.0))
    recall = F.col("correct") / F.col("actual")
    f1 = 2 * F.col("correct") / (F.col("actual") + F.col("predicted"))

    def weighted(value: Column) -> Column:
        return F.sum(F.col("actual") * value) / F.sum("actual")

    return classes.groupBy(*by).agg(
        (F.sum("correct") / F.sum("actual")).alias("accuracy"),
        weighted(precision).alias("precision"),
        weighted(recall).alias("recall"),
        weighted(f1).alias("f1"),
    )


def all_metrics(scored: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """Class metrics and ROC area side by side, one row per group."""
    metrics = class_metrics(scored, by)
    if not by:
        return metrics.withColumn("auc", area_under_roc(scored).scalar()).select(*METRICS)
    return metrics.join(area_under_roc(scored, by=by), list(by), "left").select(*by, *METRICS)


def metrics_long(metrics: DataFrame, digits: int | None = 6) -> DataFrame:
    """``(model, metric, value)`` rows."""

    def shown(c: str) -> Column:
        return F.col(c) if digits is None else F.round(c, digits)

    present = [m for m in METRICS if m in metrics.columns]
    keys = [c for c in metrics.columns if c not in present]
    rows = [(F.lit(m), shown(m)) for m in present]
    return metrics.select(*keys, long_rows(rows, ["metric", "value"]))


def model_winner(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """Both values of each metric and the better model; a tie goes to the first.

    Input: ``(model, metric, value)`` rows.
    """

    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col("value")))

    sides = metrics.groupBy("metric").agg(
        of(first).alias("first_value"), of(second).alias("second_value")
    )
    winner = F.when(F.col("first_value") >= F.col("second_value"), first).when(
        F.col("first_value") < F.col("second_value"), second
    )
    return sides.withColumn("winner", winner)


def best_models(metrics: DataFrame, models: list[str]) -> DataFrame:
    """The best of any number of models by each metric, ``(metric, winner, value)``.

    A tie goes to the model that is named first; models that are not named do not count.
    """
    place = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    best = F.max(F.struct(F.col("value"), (-place).alias("order"), F.col("model")))
    found = metrics.where(F.col("model").isin(models)).groupBy("metric").agg(best.alias("best"))
    return found.select("metric", F.col("best.model").alias("winner"), F.col("best.value").alias("value"))


def rank_importance(scores: DataFrame, score: str = "importance") -> DataFrame:
    """Rank 1..n by descending score, equal scores in feature order.

    Input: ``(position, feature, <score>)``, one row per column of a table, which is why one
    unpartitioned window is enough.
    """
    order = Window.orderBy(F.col(score).desc(), F.col("position"))
    return scores.select(F.row_number().over(order).alias("rank"), "feature", score)


def top_features(ranked: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` ranks in order."""
    return ranked.orderBy("rank").limit(n)


def prediction_table(
    predictions: DataFrame, key: str, names: tuple[str, ...] = CLASS_NAMES, digits: int = 6
) -> DataFrame:
    """Key, decoded classes and class probabilities, one row per scored row."""
    from pyspark.ml.functions import vector_to_array

    probability = vector_to_array("probability")
    return predictions.select(
        key,
        decode_label(F.col("label"), names).alias("actual_label"),
        decode_label(F.col("prediction"), names).alias("predicted_label"),
        *[F.round(probability[i], digits).alias(f"prob_{n}") for i, n in enumerate(names)],
    )
