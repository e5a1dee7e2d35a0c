"""Raw tables to exported results, end to end, and the training operators."""

import numpy as np
import pytest
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tests.test_tensors import make_slices
from voxtable.operators import evaluate, models, prepare
from voxtable.plans import dataset, eda, training
from voxtable.schemas import SLICE_META, clean_table_schema, feature_table_schema
from voxtable.sources import tables


@pytest.fixture(scope="module")
def raw(spark):
    """120 volumes; the first 60 are HGG with a larger third channel. Volume 200 has no tensors."""
    rng = np.random.default_rng(5)
    tensors, meta = [], [(200, 0, 1, 1, 1)]
    for volume in range(1, 121):
        for s in range(2):
            mask = np.zeros((4, 4, 3), int)
            mask[..., 0] = rng.random((4, 4)) < 0.3
            mask[..., 2] = rng.random((4, 4)) < (0.6 if volume <= 60 else 0.2)
            tensors.append((volume, s, rng.normal(volume <= 60, 1, (4, 4, 4)), mask))
            meta.append((volume, s, *[int(n) for n in mask.sum(axis=(0, 1))]))
    names = [(f"P_{v:03d}", "HGG" if v <= 60 else "LGG") for v in range(1, 119)]
    ages = [(f"P_{v:03d}", float(v)) for v in range(1, 100, 2)]
    return (
        spark.createDataFrame(meta, SLICE_META),
        make_slices(spark, tensors),
        spark.createDataFrame(names, "subject_id string, grade string"),
        spark.createDataFrame(ages, "subject_id string, age double"),
    )


@pytest.fixture(scope="module")
def features(raw):
    return tables.materialize(dataset.build_feature_table(*raw))


def test_feature_table(raw, features):
    assert features.columns == feature_table_schema().names
    rows = {r.volume_id: r for r in features.collect()}
    assert sorted(rows) == list(range(1, 121))
    assert rows[1].age == 1.0 and rows[2].age == 50.0  # the median of 1, 3, ..., 99
    assert rows[7].grade == "HGG" and rows[119].grade is None
    assert [r.volume_id for r in dataset.skipped_volumes(raw[0], raw[1]).collect()] == [200]


def test_reports_of_the_build(raw):
    found = dataset.build_reported(*raw)
    assert tuple(found["label_coverage"].first()) == (118, 2, 120)
    assert tuple(found["attribute_coverage"].first()) == (50, 70, 120)
    assert {r.grade: r.n for r in found["label_frequencies"].collect()} == {"HGG": 60, "LGG": 58}
    assert [r.volume_id for r in found["skipped_volumes"].collect()] == [200]
    assert [r.n_rows for r in found["rows_without_volume"].collect()] == [0, 0]


def test_switches_of_the_build(raw):
    meta, slices, names, ages = raw
    first = dataset.build_feature_table(*raw, fit_where=F.col("volume_id") <= 9)
    assert first.where("volume_id = 2").first().age == 5.0  # the median of 1, 3, 5, 7, 9
    odd = names.union(names.sparkSession.createDataFrame([("nobody", "HGG")], names.schema))
    assert dataset.build_feature_table(meta, slices, odd, ages, strict=False).count() == 120
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        dataset.build_feature_table(meta, slices, odd, ages).collect()


def test_explore_another_table(spark):
    rows = [(i, "yes" if i % 2 else None, float(i), float(i * i)) for i in range(20)]
    other = spark.createDataFrame(rows, "id int, answer string, a double, b double")
    with eda.explore(
        other, "id", "answer", "yes", "zero", sample=None, summary=None, per_class=None, drop=()
    ) as results:
        got = {name: df.collect() for name, df in results.items()}
    assert {r.column for r in got["summary"]} == {"a", "b"}
    assert sorted(r.answer for r in got["clean"]) == [0] * 10 + [1] * 10
    assert len(got["sample"][0]) == 4 and len(got["class_stats"]) == 2


def test_the_median_needs_no_window_over_all_rows(raw):
    plan = dataset.build_feature_table(*raw)._jdf.queryExecution().optimizedPlan().toString()
    for window in [line for line in plan.split("\n") if "Window [" in line]:
        # Unpartitioned windows run over one row for each range or bucket.
        assert "value#" not in window or "bucket#" in window


def test_three_models_with_a_grid(blobs):
    forests = {f"forest {n}": models.random_forest(numTrees=n, maxDepth=2) for n in (1, 2, 3)}
    depth = forests["forest 2"].maxDepth
    rows = blobs.withColumn("c", F.when(F.col("id") > 9, F.col("c"))).withColumn(
        "y", F.when(F.col("id") != 20, F.col("y"))
    )
    with training.train_and_compare(
        rows, "id", "y", ["a", "b", "c"], forests, grids={"forest 2": [{depth: 1}, {depth: 3}]}
    ) as found:
        winners = {r.metric: r.winner for r in found["model_winner"].collect()}
        assert set(winners) == set(evaluate.METRICS) and set(winners.values()) <= set(forests)
        dropped = found["dropped_rows"].first()
        assert (dropped.without_label, dropped.without_feature, dropped.kept) == (1, 10, 289)
        assert {r.folds_scored for r in found["cv_scores"].collect()} == {5}


def test_folds_of_one_class_are_not_scored(blobs):
    frame = training.training_frame(blobs, "id", ["a", "b", "c"], F.col("y"))
    one_sided = frame.withColumn("label", F.when(F.col("fold") == 2, 1.0).otherwise(F.col("label")))
    forest = models.random_forest(numTrees=2, maxDepth=2)
    with tables.cached(one_sided) as train:
        found = models.cross_validate(train, forest)
        assert found.folds_scored == 4 and 0.5 < found.best_score < 1
    with tables.cached(frame.withColumn("label", F.lit(1.0))) as train:
        nothing = models.cross_validate(train, forest)
    scores = models.cv_scores(blobs.sparkSession, {"none": nothing}).first()
    assert (scores.cv_auc, scores.folds_scored) == (None, 0)


def test_rows_without_a_key_are_refused(blobs):
    rows = blobs.withColumn("id", F.when(F.col("id") > 0, F.col("id")))
    with pytest.raises(Exception, match="row without a key"):
        prepare.hash_split(rows, "id").collect()


def test_feature_table_goes_through_csv(features, spark, tmp_path):
    tables.write_csv(features, str(tmp_path / "f"))
    again = tables.read_feature_table(spark, str(tmp_path / "f"))
    assert again.exceptAll(features).count() == features.exceptAll(again).count() == 0


def test_explore(features, spark, tmp_path):
    with eda.explore(features) as results:
        got = {name: df.collect() for name, df in results.items()}
        tables.write_csv(results["clean"], str(tmp_path / "c"))
    assert tuple(got["shape"][0]) == (120, 40)
    assert [r.volume_id for r in got["sample"]] == [1, 2, 3, 4, 5]
    assert {r.column: r.missing for r in got["missing"]}["grade"] == 2
    assert [(r.grade, r["count"]) for r in got["class_frequency"]] == [("HGG", 60), ("LGG", 58), (None, 2)]
    assert len(got["correlation"]) == 37**2 and len(got["label_correlation"]) == 37
    assert len(got["summary"]) == 7 and len(got["class_stats"]) == 3
    clean = tables.read_clean_table(spark, str(tmp_path / "c"))
    assert clean.columns == clean_table_schema().names and clean.count() == 120


@pytest.fixture(scope="module")
def results(features):
    clean = prepare.clean_features(features)
    small = {
        training.RANDOM_FOREST: models.random_forest(numTrees=5, maxDepth=3),
        training.BOOSTED_TREES: models.boosted_trees(maxIter=3, maxDepth=2),
    }
    with training.train_and_compare(
        clean.drop("t1_skewness"), estimators=small
    ) as found:
        yield found


def test_train_and_compare(results, features, spark, tmp_path):
    labelled = features.where("grade is not null").count()
    assert sum(r["count"] for r in results["class_distribution"].collect()) <= labelled
    comparison = {(r.model, r.metric): r.value for r in results["model_comparison"].collect()}
    assert len(comparison) == 10 and comparison[training.RANDOM_FOREST, "auc"] > 0.7
    assert len(results["model_winner"].collect()) == 5
    assert len(results["confusion_matrices"].collect()) == 8
    assert all(0.5 < r.cv_auc <= 1 for r in results["cv_scores"].collect())
    importance = results["gbt_feature_importance"].collect()
    assert [r["rank"] for r in importance] == list(range(1, 27))
    assert sum(r.importance for r in importance) == pytest.approx(1.0)

    training.export(results, str(tmp_path))
    names = {p.name for p in tmp_path.iterdir()}
    assert names == {
        "cv_scores",
        "model_comparison",
        "model_winner",
        "class_distribution",
        "confusion_matrices",
        "dropped_rows",
        "random_forest_feature_importance",
        "random_forest_predictions",
        "gbt_feature_importance",
        "gbt_predictions",
    }
    dropped = results["dropped_rows"].first()
    assert (dropped.without_label, dropped.total) == (2, 120)
    assert dropped.kept == dropped.total - dropped.dropped
    predictions = spark.read.csv(str(tmp_path / "gbt_predictions"), header=True)
    assert predictions.columns == ["volume_id", "actual_label", "predicted_label", "prob_LGG", "prob_HGG"]


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *rng.normal(i % 2, 0.8, 3).tolist(), float(i % 2)) for i in range(300)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double")


def test_models_do_not_depend_on_partitioning(blobs):
    weights = []
    for df in (blobs, blobs.repartition(5), blobs.orderBy(F.desc("id")).coalesce(1)):
        frame = training.training_frame(df, "id", ["a", "b", "c"], F.col("y"))
        model = models.random_forest(numTrees=4, maxDepth=3).fit(frame)
        weights.append(model.featureImportances.toArray().tolist())
    assert weights[0] == weights[1] == weights[2]


def test_grid_search_refits_the_best_candidate(blobs):
    frame = training.training_frame(blobs, "id", ["a", "b", "c"], F.col("y"))
    forest = models.random_forest(numTrees=3)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, [1, 4]).build()
    with tables.cached(frame.where("split = 'train'")) as train:
        result = models.cross_validate(train, forest, grid)
    assert len(result.scores) == 2 and result.best_score == max(result.scores)
    assert result.model.getOrDefault("maxDepth") == (1, 4)[result.best]
    scored = models.score_rows(result.model, frame.where("split = 'test'"), "rf")
    assert evaluate.class_metrics(scored).head().accuracy > 0.7
