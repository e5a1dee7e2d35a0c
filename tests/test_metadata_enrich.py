import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voxtable.functions.scalars import slice_file_ids, trailing_id
from voxtable.operators import enrich, metadata
from voxtable.schemas import SLICE_META


def test_volume_metadata_edge_cases(spark):
    rows = [
        (1, 5, 2, 0, 0),
        (1, 9, 0, 0, 2),
        (1, 7, 0, 0, 0),
        (2, 3, 0, 0, 0),  # nothing active
        (3, 4, None, 1, 0),  # a missing count is no count
        (3, None, 1, 0, 0),  # an active slice without an index is not counted
        (None, 1, 1, 1, 1),  # belongs to no volume
    ]
    result = {r.volume_id: r for r in metadata.volume_metadata(spark.createDataFrame(rows, SLICE_META)).collect()}
    assert set(result) == {1, 2, 3}
    assert result[1][1:] == (2, 0, 2, 4, 0.5, 0.0, 0.5, 2, 5, 9)
    assert result[2][1:] == (0, 0, 0, 0, 0.0, 0.0, 0.0, 0, -1, -1)
    assert result[3][1:] == (1, 1, 0, 2, 0.5, 0.5, 0.0, 1, 4, 4)


def test_missing_volumes_and_slice_stats(spark):
    slices = spark.createDataFrame([(1,), (1,), (1,), (2,)], "volume_id long")
    volumes = spark.createDataFrame([(1,), (2,), (3,)], "volume_id long")
    assert [r.volume_id for r in metadata.missing_volumes(volumes, slices).collect()] == [3]
    assert metadata.volume_slice_stats(slices).head() == (2, 1, 3, 2.0)
    assert [r.volume_id for r in metadata.volume_ids(slices).collect()] == [1, 2]


def test_missing_volumes_shuffle_distinct_ids_only(spark):
    slices = spark.range(100).select((F.col("id") % 3).alias("volume_id"))
    volumes = spark.range(100).withColumnRenamed("id", "volume_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = metadata.missing_volumes(volumes, slices)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_trailing_id_is_strict_unless_told(spark):
    names = spark.createDataFrame([("a_b_017",), ("b12",)], "name string")
    with pytest.raises(PySparkException):
        names.select(trailing_id(F.col("name"))).collect()
    assert [r[0] for r in names.select(trailing_id(F.col("name"), strict=False)).collect()] == [17, None]


def test_slice_file_ids(spark):
    path = spark.createDataFrame([("file:/d/volume_12_slice_7.h5",)], "path string")
    assert path.select(*slice_file_ids(F.col("path"))).head() == (12, 7)


def test_label_and_attribute_joins(spark):
    volumes = spark.createDataFrame([(1,), (2,), (3,)], "volume_id long")
    names = spark.createDataFrame([("s_001", "HGG"), ("s_002", "LGG"), ("s_2", "HGG")], "subject string, g string")
    labelled = enrich.attach_label(volumes, names, "subject", "g")
    rows = sorted(labelled.collect(), key=lambda r: (r.volume_id, r.grade or ""))
    assert [(r.volume_id, r.grade) for r in rows] == [(1, "HGG"), (2, "HGG"), (2, "LGG"), (3, None)]
    assert enrich.coverage(labelled, "grade").head() == (3, 1, 4)
    assert {r.grade: r.n for r in enrich.label_frequencies(labelled).collect()} == {"HGG": 2, "LGG": 1}
    ages = spark.createDataFrame([("s_001", 10.0), (None, 99.0)], "subject_id string, age double")
    with_age = enrich.attach_attribute(labelled, ages)
    assert {r.volume_id: r.age for r in with_age.where("volume_id <> 2").collect()} == {1: 10.0, 3: None}


def test_merge_keeps_volumes_on_both_sides_without_another_shuffle(spark):
    left = spark.range(50).select((F.col("id") % 5).alias("volume_id")).groupBy("volume_id").agg(F.count("*").alias("n"))
    right = spark.range(30).select((F.col("id") % 3).alias("volume_id")).groupBy("volume_id").agg(
        F.max("volume_id").alias("m"), F.count("*").alias("n")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = enrich.merge_features(left, right)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert {(r.volume_id, r.n) for r in merged.collect()} == {(0, 10), (1, 10), (2, 10)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("approx, middle", [(False, 3.0), (True, 2.0)])
def test_impute_median(spark, approx, middle):
    values = [(1.0,), (10.0,), (None,), (4.0,), (float("nan"),), (2.0,)]
    df = enrich.impute_median(spark.createDataFrame(values, "age double"), "age", approx)
    assert sorted(r.age for r in df.collect()) == sorted([1.0, 10.0, 4.0, 2.0, middle, middle])


def test_impute_median_of_other_rows(spark):
    df = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (50.0, "test"), (None, "test")], "age double, split string")
    filled = enrich.impute_median(df, "age", fit_on=df.where("split = 'train'"))
    assert sorted(r.age for r in filled.collect()) == [1.0, 2.0, 3.0, 50.0]
