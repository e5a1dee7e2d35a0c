"""Order statistics against brute force, with ties, hot values and several buckets."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from voxtable.operators import models, ordered

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def median_of(spark, values, accuracy=10_000):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    return ordered.exact_median(df, "x", accuracy).head()[0]


@FEW
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), st.sampled_from([20, 10_000]))
def test_median_of_anything(spark, values, accuracy):
    assert median_of(spark, values, accuracy) == pytest.approx(float(np.median(values)))


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_median_with_a_hot_value(spark, accuracy):
    rng = np.random.default_rng(accuracy)
    values = np.concatenate([np.full(2000, 7.0), rng.normal(7.5, 3, 3001)])
    assert median_of(spark, values.tolist(), accuracy) == float(np.median(values))
    assert median_of(spark, [1.0] * 500 + [2.0] * 500, accuracy) == 1.5


def test_median_ignores_missing_and_may_be_null(spark):
    assert median_of(spark, [None, float("nan"), 3.0, 5.0]) == 4.0
    assert median_of(spark, [None, None]) is None


def auc_by_pairs(scores, labels):
    pos, neg = scores[labels == 1][:, None], scores[labels == 0][None, :]
    return float(((pos > neg) + 0.5 * (pos == neg)).mean())


@pytest.mark.parametrize("decimals", [0, 1, 6])
def test_auc_matches_all_pairs_and_the_evaluator(spark, decimals):
    rng = np.random.default_rng(decimals)
    labels = (rng.random(1500) < 0.3).astype(float)
    scores = np.round(rng.normal(0, 1, 1500) + 0.4 * labels, decimals) + 0.0  # no negative zero
    scores[:600] = 0.0  # a hot score
    df = spark.createDataFrame(list(zip(scores.tolist(), labels.tolist())), "score double, label double")
    auc = ordered.area_under_roc(df.repartition(7)).head().auc
    assert auc == pytest.approx(auc_by_pairs(scores, labels), abs=1e-12)
    evaluator = models.auc_evaluator().setRawPredictionCol("score")
    assert auc == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_auc_per_model_and_single_class(spark):
    rows = [("a", 0.1, 0.0), ("a", 0.9, 1.0), ("b", 0.9, 0.0), ("b", 0.1, 1.0), ("c", 0.5, 1.0)]
    df = spark.createDataFrame(rows, "model string, score double, label double")
    result = ordered.area_under_roc(df, by=("model",)).collect()
    assert {r.model: r.auc for r in result} == {"a": 1.0, "b": 0.0, "c": None}


def test_buckets_follow_the_order(spark):
    df = spark.range(1000).selectExpr("cast(id as double) as v")
    splits = ordered.range_splits(df, "v", 4)
    assert len(splits) == 3 and splits == sorted(splits)
    rows = ordered.with_bucket(df, "v", splits).orderBy("v").collect()
    assert [r.bucket for r in rows] == sorted(r.bucket for r in rows)
    assert ordered.with_bucket(df, "v", []).select("bucket").distinct().count() == 1


@pytest.mark.parametrize(
    "rows, message",
    [
        ([(0.1, 0.0), (None, 1.0)], "missing score"),
        ([(0.1, 0.0), (float("nan"), 1.0)], "missing score"),
        ([(0.1, 0.0), (0.2, 2.0)], "label other than 0 and 1"),
        ([(0.1, 0.0), (0.2, None)], "label other than 0 and 1"),
    ],
)
def test_the_area_refuses_bad_rows(spark, rows, message):
    scored = spark.createDataFrame(rows, "score double, label double")
    with pytest.raises(Exception, match=message):
        ordered.area_under_roc(scored).collect()


def test_median_of_many_rows_without_a_window_over_them(spark):
    rng = np.random.default_rng(6)
    values = np.round(rng.normal(0, 1, 20_001), 3)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for accuracy in (2, 100, 10_000):
        median = ordered.exact_median(df, "v", accuracy)
        assert median.first()[0] == float(np.median(values))
        plan = median._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.split("\n"):
            if "Window [" in line and "value#" in line:
                assert "[bucket#" in line


def test_every_group_is_cut_at_quantiles_of_its_own(spark):
    rng = np.random.default_rng(4)
    ranges = {f"m{i}": (10.0 ** (3 * i - 9), 5.0 * i) for i in range(7)}
    rows = [(m, float(at + width * v), float(v > 0.3)) for m, (width, at) in ranges.items() for v in rng.normal(0, 1, 400)]
    df = spark.createDataFrame(rows, "model string, score double, label double").repartition(5)
    found = ordered.with_group_bucket(df, "score", ("model",), 8)
    sizes = found.groupBy("model", "bucket").count().collect()
    assert {r.model for r in sizes} == set(ranges) and len(sizes) == 7 * 8
    assert all(30 <= r["count"] <= 70 for r in sizes)
    by_score = found.orderBy("model", "score").collect()
    assert all(a.bucket <= b.bucket for a, b in zip(by_score, by_score[1:]) if a.model == b.model)
    areas = {r.model: r.auc for r in ordered.area_under_roc(df, by=("model",)).collect()}
    for model in ranges:
        scores, labels = np.array([r[1:] for r in rows if r[0] == model]).T
        assert areas[model] == pytest.approx(auc_by_pairs(scores, labels), abs=1e-12)


def test_groups_without_a_name_are_groups(spark):
    rows = [(None, 0.1, 0.0), (None, 0.9, 1.0), ("b", 0.9, 0.0), ("b", 0.1, 1.0)]
    df = spark.createDataFrame(rows, "model string, score double, label double")
    assert {r.model: r.auc for r in ordered.area_under_roc(df, by=("model",)).collect()} == {None: 1.0, "b": 0.0}
