import pytest
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from voxtable.operators import evaluate, prepare


@pytest.fixture(scope="module")
def scored(spark):
    rows = [("a", 0.0, 0.0, 0.1)] * 9 + [("a", 0.0, 1.0, 0.7)] + [("a", 1.0, 1.0, 0.9)] * 45
    rows += [("b", 0.0, 1.0, 0.6)] * 4 + [("b", 1.0, 1.0, 0.6)] * 6  # class 0 is never predicted
    return spark.createDataFrame(rows, "model string, label double, prediction double, score double")


def test_confusion_matrix_keeps_empty_cells(scored):
    rows = evaluate.confusion_matrix(scored, by=("model",)).collect()
    got = {(r.model, r.actual, r.predicted): r["count"] for r in rows}
    assert got == {
        ("a", "LGG", "LGG"): 9,
        ("a", "LGG", "HGG"): 1,
        ("a", "HGG", "LGG"): 0,
        ("a", "HGG", "HGG"): 45,
        ("b", "LGG", "LGG"): 0,
        ("b", "LGG", "HGG"): 4,
        ("b", "HGG", "LGG"): 0,
        ("b", "HGG", "HGG"): 6,
    }


def test_confusion_matrix_refuses_unnamed_classes(spark):
    df = spark.createDataFrame([(0.0, 2.0)], "label double, prediction double")
    with pytest.raises(PySparkException, match="outside the named classes"):
        evaluate.confusion_matrix(df).collect()
    named = evaluate.confusion_matrix(df, ("x", "y", "z")).collect()
    assert {(r.actual, r.predicted): r["count"] for r in named}["x", "z"] == 1 and len(named) == 9


@pytest.mark.parametrize("model", ["a", "b"])
def test_class_metrics_match_the_evaluators(scored, model):
    own = scored.where(F.col("model") == model)
    names = {
        "accuracy": "accuracy",
        "precision": "weightedPrecision",
        "recall": "weightedRecall",
        "f1": "f1",
    }
    got = evaluate.class_metrics(own).head()
    for name, metric in names.items():
        assert got[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(own))


def test_metrics_of_the_published_confusion(scored):
    # 9, 1, 0, 45 gives accuracy 0.981818, precision 0.982213, recall 0.981818 and f1 0.98144.
    long = evaluate.metrics_long(evaluate.all_metrics(scored)).where("model = 'a'").collect()
    got = {r.metric: r.value for r in long}
    assert got.pop("auc") == 1.0
    assert got == {"accuracy": 0.981818, "precision": 0.982213, "recall": 0.981818, "f1": 0.98144}
    single = evaluate.all_metrics(scored.where("model = 'a'").drop("model"), by=()).head()
    assert single.auc == 1.0 and round(single.f1, 5) == 0.98144


def test_winner_takes_ties_first(spark):
    rows = [("a", "auc", 1.0), ("b", "auc", 1.0), ("a", "f1", 0.5), ("b", "f1", 0.6)]
    metrics = spark.createDataFrame(rows, "model string, metric string, value double")
    assert {r.metric: r.winner for r in evaluate.model_winner(metrics, "a", "b").collect()} == {"auc": "a", "f1": "b"}
    assert {r.metric: r.winner for r in evaluate.model_winner(metrics, "b", "a").collect()} == {"auc": "b", "f1": "b"}


def test_ranks_keep_feature_order_on_ties(spark):
    scores = spark.createDataFrame(
        [(2, "z", 0.2), (0, "b", 0.2), (1, "a", 0.6)], "position int, feature string, importance double"
    )
    ranked = evaluate.rank_importance(scores)
    assert [tuple(r)[:2] for r in evaluate.top_features(ranked, 3).collect()] == [(1, "a"), (2, "b"), (3, "z")]
    assert evaluate.top_features(ranked, 1).head().feature == "a"


def test_hash_split_is_stable_disjoint_and_complete(spark):
    df = spark.range(5000)
    one = prepare.hash_split(df, "id").orderBy("id").collect()
    assert one == prepare.hash_split(df.repartition(9), "id").orderBy("id").collect()
    assert 0.77 < sum(r.split == "train" for r in one) / 5000 < 0.83
    assert {r.fold for r in one} == {0, 1, 2, 3, 4}
    for split in ("train", "test"):  # folds are independent of the split
        sizes = [sum(r.split == split and r.fold == k for r in one) for k in range(5)]
        assert max(sizes) < 1.4 * min(sizes)


def test_assemble_drops_missing_rows_and_reports_them(spark):
    rows = [(1, 1.0, 2, 1), (2, None, 2, 0), (3, float("nan"), 1, 1), (4, 1.0, 3, None)]
    df = spark.createDataFrame(rows, "id long, x double, y int, label int")
    kept = prepare.assemble(df, ["x", "y"], F.col("label"), carry=("id",)).collect()
    assert [(r.id, r.features.toArray().tolist(), r.label) for r in kept] == [(1, [1.0, 2.0], 1.0)]
    assert tuple(prepare.assemble_report(df, ["x", "y"]).head()) == (2, 2, 0, 2, 4)
    assert tuple(prepare.assemble_report(df, ["x", "y"], F.col("label")).head()) == (1, 3, 1, 2, 4)


def test_clean_features(spark):
    df = spark.createDataFrame(
        [(1, 5, "HGG"), (2, 6, None)], "volume_id long, t2_max long, grade string"
    )
    assert [tuple(r) for r in prepare.clean_features(df).collect()] == [(1, 1), (2, None)]
    assert [tuple(r) for r in prepare.clean_features(df, unmatched="zero").collect()] == [(1, 1), (2, 0)]
    with pytest.raises(ValueError):
        prepare.clean_features(df, unmatched="one")
