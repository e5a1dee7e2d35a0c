import os

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from pyspark.sql import functions as F

from voxtable.operators import enrich, metadata, tensors
from voxtable.schemas import SLICE_META, clean_table_schema, feature_table_schema
from voxtable.sources import slices, tables


def test_raw_tables_are_read_by_header_name(spark, tmp_path):
    meta = tmp_path / "meta.csv"
    meta.write_text(
        "slice_path,target,volume,slice,label0_pxl_cnt,label1_pxl_cnt,label2_pxl_cnt,ratio\n"
        "a.h5,0,41,0,3,,5,0.1\nb.h5,1,41,1,0,0,0,0.2\n"
    )
    df = tables.read_slice_meta(spark, str(meta))
    assert df.schema.simpleString() == SLICE_META.simpleString()
    assert [tuple(r) for r in df.orderBy("slice").collect()] == [(41, 0, 3, None, 5), (41, 1, 0, 0, 0)]

    names = tmp_path / "names.csv"
    names.write_text("Grade,Other,Subject\nHGG,x,S_001\n")
    assert tables.read_name_map(spark, str(names), "Subject").head() == ("S_001", "HGG")
    ages = tmp_path / "ages.csv"
    ages.write_text("Id,Age,Days\nS_001,60.5,1\nS_002,,2\n")
    rows = tables.read_attribute(spark, str(ages), "Id").orderBy("subject_id").collect()
    assert [tuple(r) for r in rows] == [("S_001", 60.5), ("S_002", None)]


def test_malformed_cells_fail(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("volume_id,slice,n0,n1,n2\n1,2,three,4,5\n")
    with pytest.raises(Py4JJavaError, match="Malformed records"):
        tables.read_csv(spark, str(bad), SLICE_META).collect()
    renamed = tmp_path / "renamed.csv"
    renamed.write_text("volume,slice,n0,n1,n2\n1,2,3,4,5\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_csv(spark, str(renamed), SLICE_META).collect()


@pytest.mark.parametrize("row", ["1,2,3,4", "1,2,3,4,5,6"])
def test_rows_of_another_width_fail_under_every_projection(spark, tmp_path, row):
    path = tmp_path / "bad.csv"
    path.write_text(f"volume,slice,label0_pxl_cnt,label1_pxl_cnt,label2_pxl_cnt\n{row}\n")
    for columns in (["volume_id"], ["n0", "slice"], SLICE_META.names):
        with pytest.raises((PySparkException, Py4JJavaError)):
            tables.read_slice_meta(spark, str(path)).select(*columns).collect()
    path.write_text(f"volume_id,slice,n0,n1,n2\n{row}\n")
    for columns in (["volume_id"], SLICE_META.names):
        with pytest.raises((PySparkException, Py4JJavaError)):
            tables.read_csv(spark, str(path), SLICE_META).select(*columns).collect()


def test_text_with_quotes_and_line_breaks_goes_through_csv(spark, tmp_path):
    texts = ["plain", 'a "quoted" word', "two\nlines", 'both "\n" , and commas', "back\\slash", '"']
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "id int, a string, b string")
    path = str(tmp_path / "text")
    tables.write_csv(df, path)
    for again in (
        tables.read_csv(spark, path, df.schema, multi_line=True),
        tables.read_columns(
            spark, path, {"id": ("id", "int"), "a": ("a", "string"), "b": ("b", "string")}, multi_line=True
        ),
    ):
        assert sorted(tuple(r) for r in again.collect()) == sorted((i, t, t) for i, t in enumerate(texts))


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_one_large_file_is_read_in_several_tasks(spark, tmp_path, small_splits):
    path = str(tmp_path / "large")
    rows = spark.range(30_000).selectExpr(
        "id as volume_id", "cast(id % 7 as int) as slice", "id * 2 as n0", "id % 3 as n1", "0L as n2"
    )
    tables.write_csv(rows, path, single_file=True)
    again = tables.read_csv(spark, path, SLICE_META)
    parts = {r.part for r in again.select(F.spark_partition_id().alias("part")).distinct().collect()}
    assert len(parts) > 4
    assert again.exceptAll(rows).count() == 0 and again.count() == 30_000
    whole = tables.read_csv(spark, path, SLICE_META, multi_line=True)
    assert whole.select(F.spark_partition_id()).distinct().count() == 1
    (file,) = (tmp_path / "large").glob("part-*")
    with open(file, "a") as out:
        out.write("1,2,3,4\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_csv(spark, path, SLICE_META).select("volume_id").collect()


def test_a_quoted_line_break_fails_where_it_is_not_expected(spark, tmp_path):
    path = tmp_path / "breaks.csv"
    path.write_text('a,b,c\n1,"two\nlines",3\n')
    columns = {"a": ("a", "int"), "b": ("b", "string")}
    assert tables.read_columns(spark, str(path), columns, multi_line=True).first().b == "two\nlines"
    with pytest.raises((PySparkException, Py4JJavaError)):
        tables.read_columns(spark, str(path), columns).collect()


def _exists(df):
    return os.path.exists(df.inputFiles()[0].removeprefix("file://"))


def test_work_tables_go_at_the_end_of_their_block(spark):
    df = spark.range(10)
    with tables.work_tables(spark):
        outer = tables.materialize(df)
        with tables.work_tables(spark):
            inner, kept = tables.materialize(df), tables.materialize(df, keep=True)
            assert _exists(inner) and _exists(kept) and inner.count() == 10
        assert not _exists(inner) and _exists(outer) and kept.count() == 10
    assert not _exists(outer) and _exists(kept)
    assert _exists(tables.materialize(df))  # outside of any block nothing is deleted


def test_work_tables_go_when_the_body_fails(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    with pytest.raises(ZeroDivisionError), tables.work_tables(spark):
        tables.materialize(spark.range(10))
        raise ZeroDivisionError
    with pytest.raises((PySparkException, Py4JJavaError)), tables.work_tables(spark):
        tables.materialize(spark.range(10).select(F.raise_error(F.lit("no"))))
    assert set(os.listdir(base)) == before


def _tensors(spark, volumes, per_volume=3):
    return spark.range(volumes * per_volume).selectExpr(
        f"id div {per_volume} as volume_id",
        "id as slice_idx",
        "1 as h",
        "2 as w",
        "array(1f, 2f, 3f, 4f, 5f, 6f, 7f, cast(id as float)) as image",
        "array(1Y, 0Y, 0Y, 0Y, cast(id % 2 as byte), 0Y) as mask",
    )


def test_clustered_slices_are_pruned_and_need_no_exchange(spark, tmp_path):
    path, meta_path = str(tmp_path / "t"), str(tmp_path / "m")
    tensors_in = _tensors(spark, 40)
    meta_in = spark.range(120).selectExpr("id div 3 as volume_id", "cast(id as int) as slice", "id as n0", "1L as n1", "0L as n2")
    slices.write_clustered(tensors_in, path, 4)
    slices.write_clustered(meta_in, meta_path, 4, order="slice")
    stored = slices.read_clustered(spark, path, 4)
    meta = slices.read_clustered(spark, meta_path, 4, SLICE_META, order="slice")
    assert stored.exceptAll(tensors_in).count() == 0 and stored.count() == 120
    assert meta.exceptAll(meta_in).count() == 0
    assert len(stored.inputFiles()) == 4

    one = stored.where("volume_id = 7")
    assert "SelectedBucketsCount: 1 out of 4" in _plan(one.groupBy("volume_id").count())
    features = tensors.volume_features(stored)
    assert "Exchange" not in _plan(features) and features.count() == 40
    merged = enrich.merge_features(metadata.volume_metadata(meta), features)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Exchange" not in _plan(merged) and merged.count() == 40
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

    (own,) = {os.path.basename(r[0]) for r in one.select("_metadata.file_path").collect()}
    for file in (tmp_path / "t").glob("*.parquet"):
        if file.name != own:
            file.write_bytes(b"not to be read")
    assert slices.read_clustered(spark, path, 4).where("volume_id = 7").count() == 3


def test_a_hot_volume_is_dealt_to_several_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = _tensors(spark, 1, 300).unionByName(_tensors(spark, 50).withColumn("volume_id", F.col("volume_id") + 1))
    slices.write_clustered(rows, path, 4, rows_per_file=50)
    stored = slices.read_clustered(spark, path, 4)
    sizes = [r['count'] for r in stored.groupBy('_metadata.file_path').count().collect()]
    assert len(sizes) >= 9 and max(sizes) < 100
    assert stored.exceptAll(rows).count() == 0 and stored.count() == 450
    split = slices.read_clustered(spark, path, 4, max_bucket_bytes=1)
    assert "Bucketed: true" not in _plan(split) and split.exceptAll(rows).count() == 0
    expected = {r.volume_id: r.n_slices for r in tensors.volume_features(rows).collect()}
    for read in (stored, split):
        assert {r.volume_id: r.n_slices for r in tensors.volume_features(read).collect()} == expected


def test_files_of_other_types_are_named(spark, tmp_path):
    path = str(tmp_path / "mixed")
    rows = _tensors(spark, 4).coalesce(1)
    rows.write.parquet(path)
    rows.limit(2).withColumn("image", F.col("image").cast("array<double>")).write.mode("append").parquet(path)
    rows.limit(1).drop("mask").write.mode("append").parquet(path)
    types = slices.stored_types(spark, path)
    census = sorted(tuple(r) for r in slices.type_census(types).fillna("none").collect())
    assert census == [("double", "int8", 2), ("float", "int8", 12), ("float", "none", 1)]
    other = slices.files_of_other_types(types).collect()
    assert sorted((r.image_type, r.mask_type) for r in other) == [("double", "int8"), ("float", None)]
    assert all(r.path.endswith(".parquet") for r in other)


def test_slice_files_hold_the_arrays(spark, tmp_path):
    folder = str(tmp_path / "files")
    slices.write_slice_files(_tensors(spark, 2), folder)
    listed = slices.list_slice_files(spark, folder, "*.npz").collect()
    assert sorted((r.volume_id, r.slice_idx) for r in listed) == [(i // 3, i) for i in range(6)]
    with np.load(f"{folder}/volume_1_slice_5.npz") as file:
        assert file["image"].shape == (1, 2, 4) and file["image"][0, 1, 3] == 5
        assert file["mask"].shape == (1, 2, 3) and file["mask"].dtype == np.int8


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_sink_keeps_values_missing_cells_and_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 2, 3, None, 5), (6, 7, 8, 9, 10)], SLICE_META).repartition(2)
    for single in (False, True):
        tables.write_csv(df, path, single_file=single)
        assert len(list((tmp_path / "out").glob("part-*"))) == (1 if single else 2)
        rows = tables.read_csv(spark, path, SLICE_META).orderBy("volume_id").collect()
        assert [tuple(r) for r in rows] == [(1, 2, 3, None, 5), (6, 7, 8, 9, 10)]


def test_table_widths():
    assert len(feature_table_schema()) == 40
    assert len(clean_table_schema()) == 29


def test_work_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = tables.work_folder(spark), tables.work_folder(spark)
    assert one.startswith(base) and one != two


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    for volume, idx in [(1, 2), (1, 10), (12, 0)]:
        (folder / f"volume_{volume}_slice_{idx}.npz").write_bytes(b"any content")
    (folder / "notes.txt").write_text("not a slice")
    return folder


def test_file_listing_reads_no_content(spark, folder):
    files = slices.list_slice_files(spark, str(folder), "*.npz")
    assert sorted((r.volume_id, r.slice_idx) for r in files.collect()) == [(1, 2), (1, 10), (12, 0)]
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string>" in plan


def test_binarised(spark):
    df = spark.createDataFrame([([0.0, 0.25, 0.3],)], "m array<float>")
    assert df.select(slices.binarised("m", 0.25).alias("b")).head().b == [0, 0, 1]
