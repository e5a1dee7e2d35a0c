"""

Every query runs over whole tables. Doubles are rounded here, not in the operators, because the
order of a distributed sum shows in the last digits.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle_queries import EDA_COLUMNS, META_COLUMNS, ORACLES
from voxtable.operators import (
    correlate,
    enrich,
    evaluate,
    metadata,
    models,
    ordered,
    prepare,
    profile,
    tensors,
)
from voxtable.functions.scalars import numeric_columns, slice_file_ids
from voxtable.plans import dataset, training
from voxtable.schemas import SLICE_META
from voxtable.sources import slices, standins, tables

try:  # the operators on documents can be taken out as a whole
    import corpus_pipeline
    import voxtable.llm.queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

MODELS = {"value > 100": 100.0, "value > 50": 50.0}
COLUMNS = list(EDA_COLUMNS)


def _rounded(df: DataFrame, digits: int = 6, **own: int) -> DataFrame:
    """Doubles rounded for comparison, without a negative zero."""
    return df.select(
        *[
            (F.round(f.name, own.get(f.name, digits)) + 0.0).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _on(view: Query, operator: Callable[[DataFrame], DataFrame], **digits: int) -> Query:
    return lambda spark, sf: _rounded(operator(view(spark, sf)), **digits)


def _missing_volumes(spark: SparkSession, sf: str) -> DataFrame:
    return metadata.missing_volumes(standins.volumes(spark, sf), standins.slice_meta(spark, sf))


def _slice_file_ids(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat_ws("_", F.lit("data/volume"), "volume_id", F.lit("slice"), "slice")
    files = standins.slice_meta(spark, sf).select(F.concat(name, F.lit(".h5")).alias("path"))
    volume_id, slice_idx = slice_file_ids(F.col("path"))
    return files.select("path", volume_id.alias("volume_id"), slice_idx.alias("slice_idx"))


def _raw_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The three raw tables written under their own header names, with more columns than are read."""
    folder = tables.work_folder(spark)
    headers = dict(zip(SLICE_META.names, tables.SLICE_META_HEADERS))
    meta = standins.slice_meta(spark, sf).withColumnsRenamed(headers)
    tables.write_csv(meta.select(F.lit("a, b").alias("path"), "*", F.lit(0.5)), f"{folder}/meta")
    names = standins.nation_map(spark, sf).select(
        F.lit('a "quoted"\nline').alias("note"),
        F.col("grade").alias("Grade"),
        F.col("subject_id").alias("Subject"),
    )
    tables.write_csv(names, f"{folder}/names")
    ages = standins.survival(spark, sf).select(
        F.col("subject_id").alias("Subject"), F.lit(1).alias("Days"), F.col("age").alias("Age")
    )
    tables.write_csv(ages, f"{folder}/ages")
    none = F.lit(None).cast("string")
    slice_rows = tables.read_slice_meta(spark, f"{folder}/meta").select(
        F.lit("slice").alias("kind"),
        F.concat_ws(":", "volume_id", "slice").alias("key"),
        F.concat_ws(":", "n0", "n1", "n2").alias("text"),
        F.lit(None).cast("double").alias("number"),
    )
    name_rows = tables.read_name_map(spark, f"{folder}/names", "Subject").select(
        F.lit("name"), "subject_id", "grade", F.lit(None).cast("double")
    )
    age_rows = tables.read_attribute(spark, f"{folder}/ages", "Subject").select(
        F.lit("age"), "subject_id", none, "age"
    )
    return slice_rows.union(name_rows).union(age_rows)


def _clean_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = tables.work_folder(spark)
    tables.write_csv(prepare.clean_features(_feature_table(spark, sf)), folder)
    return tables.read_clean_table(spark, folder)


def _single_file_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = tables.work_folder(spark)
    tables.write_csv(metadata.volume_slice_stats(standins.slice_meta(spark, sf)), folder, True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    stats = tables.read_columns(
        spark, folder, {"n_volumes": ("n_volumes", "bigint"), "mean_slices": ("mean_slices", "double")}
    )
    return stats.withColumn("n_files", files.agg(F.count("*")).scalar())


def _csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = tables.work_folder(spark)
    tables.write_csv(standins.slice_meta(spark, sf), folder)
    return tables.read_csv(spark, folder, SLICE_META)


def _slice_listing(spark: SparkSession, sf: str) -> DataFrame:
    """The slices written as one file each, listed by the names of the files."""
    folder = tables.work_folder(spark)
    slices.write_slice_files(standins.tensor_slices(spark, sf), folder)
    return slices.list_slice_files(spark, folder, "*.npz").select("volume_id", "slice_idx")


def _mixed_types(spark: SparkSession, sf: str) -> DataFrame:
    """Slices of which every third is stored with doubles and integers, and the census of the files."""
    folder, whole = tables.work_folder(spark), standins.tensor_slices(spark, sf)
    third = F.col("slice_idx") % 3 == 0
    wider = {"image": F.col("image").cast("array<double>"), "mask": F.col("mask").cast("array<int>")}
    whole.where(~third).write.mode("append").parquet(folder)
    whole.where(third).withColumns(wider).write.mode("append").parquet(folder)
    return slices.type_census(slices.stored_types(spark, folder))


BUCKETS = 8


def _clustered(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Slices and their metadata stored by volume, and read again."""
    tensor_path, meta_path = tables.work_folder(spark), tables.work_folder(spark)
    slices.write_clustered(standins.tensor_slices(spark, sf), tensor_path, BUCKETS)
    slices.write_clustered(standins.slice_meta(spark, sf), meta_path, BUCKETS, order="slice")
    return (
        slices.read_clustered(spark, tensor_path, BUCKETS),
        slices.read_clustered(spark, meta_path, BUCKETS, SLICE_META, order="slice"),
    )


def _clustered_slices(spark: SparkSession, sf: str) -> DataFrame:
    tensor_slices, _ = _clustered(spark, sf)
    pixels = F.aggregate("image", F.lit(0.0), lambda total, v: total + v.cast("double"))
    return tensor_slices.select(
        "volume_id", "slice_idx", "h", "w", F.size("mask").alias("mask_size"), pixels.alias("total")
    )


def _clustered_features(spark: SparkSession, sf: str) -> DataFrame:
    tensor_slices, meta = _clustered(spark, sf)
    features = tensors.volume_features(tensor_slices)
    kept = ["volume_id", "n_slices", "union_voxels", "flair_mean", "centroid_x"]
    features = features.withColumnRenamed("total_tumour_voxels", "union_voxels").select(kept)
    return enrich.merge_features(metadata.volume_metadata(meta), features)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    volumes, mapping = standins.nation_volumes(spark, sf), standins.nation_map(spark, sf)
    labelled = enrich.attach_label(volumes, mapping)
    return labelled.select("c_custkey", "volume_id", "subject_id", "grade")


def _with_attribute(spark: SparkSession, sf: str) -> DataFrame:
    subjects = standins.subjects(spark, sf).select(
        F.regexp_extract("subject_id", "#(\\d+)$", 1).cast("bigint").alias("volume_id"),
        "subject_id",
    )
    return enrich.attach_attribute(subjects, standins.survival(spark, sf))


def _imputed(spark: SparkSession, sf: str) -> DataFrame:
    joined = _with_attribute(spark, sf)
    return enrich.impute_median(joined, "age").select("volume_id", "subject_id", "age")


def _feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return dataset.build_feature_table(
        standins.slice_meta(spark, sf),
        standins.tensor_slices(spark, sf),
        standins.subjects(spark, sf),
        standins.survival(spark, sf),
        id_pattern=r"#(\d+)$",
    )


def _build_reports(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage and counts of the build, as (report, what, n)."""
    found = dataset.build_reported(
        standins.slice_meta(spark, sf),
        standins.tensor_slices(spark, sf),
        standins.subjects(spark, sf),
        standins.survival(spark, sf),
        id_pattern=r"#(\d+)$",
    )
    report, what = F.lit("label").alias("report"), F.col("grade").alias("what")
    parts = [found["label_frequencies"].select(report, what, "n")]
    for report in ("label_coverage", "attribute_coverage"):
        for what in ("present", "missing", "total"):
            parts.append(found[report].select(F.lit(report), F.lit(what), what))
    parts.append(found["rows_without_volume"].select(F.lit("rows_without_volume"), "input", "n_rows"))
    skipped = found["skipped_volumes"].agg(F.count("*"))
    parts.append(skipped.select(F.lit("skipped_volumes"), F.lit("total"), "*"))
    result = parts[0]
    for part in parts[1:]:
        result = result.union(part)
    return result


def _skipped_volumes(spark: SparkSession, sf: str) -> DataFrame:
    slices = standins.tensor_slices(spark, sf)
    return dataset.skipped_volumes(standins.slice_meta(spark, sf), slices)


def _sample(df: DataFrame) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
    return profile.sample_rows(df, ["l_orderkey", "l_linenumber", "l_extendedprice"], columns)


def _label_corr(df: DataFrame) -> DataFrame:
    label = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    return correlate.feature_label_corr(df, COLUMNS, label)


def _ranked(df: DataFrame) -> DataFrame:
    position = F.array_position(F.array(*[F.lit(c) for c in COLUMNS]), F.col("feature"))
    scores = _label_corr(df).select(
        position.alias("position"), "feature", F.col("abs_corr").alias("importance")
    )
    return evaluate.rank_importance(scores)


MISSING_COLUMNS = ["doc_id", "n_chars", "quality", "toxic"]


def _pearson_missing(df: DataFrame) -> DataFrame:
    matrices = [
        correlate.pearson_matrix(df, MISSING_COLUMNS, method, digits=4).withColumn("method", F.lit(method))
        for method in ("listwise", "pairwise")
    ]
    return matrices[0].unionByName(matrices[1])


def _label_corr_missing(df: DataFrame) -> DataFrame:
    return correlate.feature_label_corr(df, ["doc_id", "n_chars", "toxic"], F.col("quality"))


def _describe_by_dtype(df: DataFrame) -> DataFrame:
    return profile.describe_numeric(df, numeric_columns(df, exclude=("doc_id",)))


def _meta_matrix(meta: DataFrame) -> DataFrame:
    return correlate.pearson_matrix(metadata.volume_metadata(meta), META_COLUMNS, digits=4)


def _split(df: DataFrame) -> DataFrame:
    return prepare.hash_split(df, "doc_id").select("doc_id", "label", "split", "fold")


def _two_models(spark: SparkSession, sf: str) -> DataFrame:
    return standins.scored(spark, sf, MODELS)


def _metrics_long(scored: DataFrame) -> DataFrame:
    return evaluate.metrics_long(evaluate.all_metrics(scored))


def _frame(spark: SparkSession, sf: str) -> DataFrame:
    return training.training_frame(
        standins.training(spark, sf), "doc_id", standins.TRAINING_FEATURES, F.col("label")
    )


def _cross_validated(name: str, estimator) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        with tables.cached(_frame(spark, sf).where(F.col("split") == "train")) as train:
            return models.cv_scores(spark, {name: models.cross_validate(train, estimator())})

    return query


def _fitted(spark: SparkSession, sf: str, estimator):
    frame = _frame(spark, sf)
    with tables.cached(frame.where(F.col("split") == "train")) as train:
        return estimator.fit(train), frame.where(F.col("split") == "test")


def _exact_forest():
    """Every tree sees every feature, so that each finds the one that is the label."""
    return models.random_forest(numTrees=5, featureSubsetStrategy="all")


def _exact_frame(spark: SparkSession, sf: str) -> DataFrame:
    rows = standins.exact_training(spark, sf)
    return training.training_frame(rows, "doc_id", standins.EXACT_FEATURES, F.col("label"))


def _exact_scored(spark: SparkSession, sf: str, estimator) -> DataFrame:
    frame = _exact_frame(spark, sf)
    with tables.cached(frame.where(F.col("split") == "train")) as train:
        model = estimator.fit(train)
    return models.score_rows(model, frame.where(F.col("split") == "test"), "exact")


def _exact_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.prediction_table(_exact_scored(spark, sf, _exact_forest()), "doc_id")


def _exact_boosted(spark: SparkSession, sf: str) -> DataFrame:
    scored = _exact_scored(spark, sf, models.boosted_trees(maxIter=3))
    return evaluate.confusion_matrix(scored)


def _exact_cv(spark: SparkSession, sf: str) -> DataFrame:
    with tables.cached(_exact_frame(spark, sf).where(F.col("split") == "train")) as train:
        return models.cv_scores(spark, {"exact": models.cross_validate(train, _exact_forest())})


def _exact_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The deeper candidate wins: a tree without a split knows nothing."""
    forest = _exact_forest()
    grid = [{forest.maxDepth: 0}, {forest.maxDepth: 2}]
    with tables.cached(_exact_frame(spark, sf).where(F.col("split") == "train")) as train:
        found = models.cross_validate(train, forest, grid)
    rows = [(i, float(score), i == found.best) for i, score in enumerate(found.scores)]
    return spark.createDataFrame(rows, "candidate int, cv_auc double, best boolean")


def _exact_importance(spark: SparkSession, sf: str) -> DataFrame:
    frame = _exact_frame(spark, sf)
    model = _exact_forest().fit(frame.where(F.col("split") == "train"))
    return models.feature_importance(spark, model, standins.EXACT_FEATURES)


def _prediction_totals(spark: SparkSession, sf: str) -> DataFrame:
    total = F.round(F.col("prob_LGG") + F.col("prob_HGG"), 5).alias("total")
    return _predictions(spark, sf).select("doc_id", "actual_label", total)


def _importance_total(spark: SparkSession, sf: str) -> DataFrame:
    return _importance(spark, sf).agg(F.round(F.sum("importance"), 6).alias("total"))


def _importance(spark: SparkSession, sf: str) -> DataFrame:
    model, _ = _fitted(spark, sf, models.random_forest())
    weights = models.feature_importance(spark, model, standins.TRAINING_FEATURES)
    return evaluate.rank_importance(weights)


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    model, test = _fitted(spark, sf, models.random_forest())
    scored = models.score_rows(model, test, training.RANDOM_FOREST)
    return evaluate.prediction_table(scored, "doc_id")


def _model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    clean = standins.training(spark, sf)
    with training.train_and_compare(
        clean, "doc_id", "label", standins.TRAINING_FEATURES
    ) as results:
        return tables.materialize(results["model_comparison"], keep=True)


def entry(spark: SparkSession) -> DataFrame:
    """Metadata features of every volume at the smallest scale."""
    return queries()["slice_meta_features"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator; each takes (spark, sf_dir)."""
    meta, tensor_slices = standins.slice_meta, standins.tensor_slices
    lines, documents = standins.eda_lines, standins.eda_documents
    on_documents = {}
    if llm_queries:
        on_documents = {**llm_queries.queries(), "pipeline": corpus_pipeline.run}
    return {
        **on_documents,
        "slice_meta_features": _on(meta, metadata.volume_metadata),
        "missing_volumes": _missing_volumes,
        "volume_slice_stats": _on(meta, metadata.volume_slice_stats),
        "volume_ids": _on(meta, metadata.volume_ids),
        "slice_file_ids": _slice_file_ids,
        "slice_listing": _slice_listing,
        "clustered_slices": lambda spark, sf: _rounded(_clustered_slices(spark, sf)),
        "clustered_features": lambda spark, sf: _rounded(_clustered_features(spark, sf)),
        "mixed_types": _mixed_types,
        "csv_roundtrip": _csv_roundtrip,
        "raw_tables": _raw_tables,
        "clean_roundtrip": lambda spark, sf: _rounded(_clean_roundtrip(spark, sf)),
        "single_file_roundtrip": _single_file_roundtrip,
        "intensity_features": _on(tensor_slices, tensors.intensity_features),
        "intensity_features_wide": _on(tensor_slices, tensors.intensity_features_wide),
        "spatial_features": _on(tensor_slices, tensors.spatial_features),
        "slice_extent": _on(tensor_slices, tensors.slice_extent),
        "first_active_slice": _on(tensor_slices, tensors.first_active_slice),
        "all_features": _on(tensor_slices, tensors.volume_features),
        "mask_values_per_slice": _on(tensor_slices, tensors.mask_values_per_slice),
        "mask_values_per_channel": _on(tensor_slices, tensors.mask_values_per_channel),
        "mask_values_per_volume": _on(tensor_slices, tensors.mask_values),
        "mask_values_per_volume_channel": _on(
            tensor_slices, lambda df: tensors.mask_values(df, per_channel=True)
        ),
        "active_pixels": _on(tensor_slices, tensors.active_pixels),
        "channel_overlap": _on(tensor_slices, tensors.channel_overlap),
        "channel_disjoint": _on(tensor_slices, tensors.channel_disjoint),
        "tensor_shape_census": _on(standins.ragged_slices, tensors.tensor_shape_census),
        "attach_label": _labelled,
        "label_coverage": _on(_labelled, lambda df: enrich.coverage(df, "grade")),
        "label_frequencies": _on(_labelled, enrich.label_frequencies),
        "attach_attribute_median": lambda spark, sf: _rounded(_imputed(spark, sf)),
        "attribute_coverage": _on(_with_attribute, lambda df: enrich.coverage(df, "age")),
        "exact_median": _on(lines, lambda df: ordered.exact_median(df, "l_extendedprice")),
        "feature_table": lambda spark, sf: _rounded(_feature_table(spark, sf)),
        "clean_features": _on(_feature_table, prepare.clean_features),
        "skipped_volumes": _skipped_volumes,
        "dataset_shape": _on(lines, profile.dataset_shape),
        "sample_rows": _on(lines, _sample),
        "describe_numeric": _on(lines, lambda df: profile.describe_numeric(df, COLUMNS), stddev=4),
        "missing_counts": _on(documents, profile.missing_counts),
        "group_frequency": _on(lines, lambda df: profile.group_frequency(df, "l_returnflag")),
        "group_stats": _on(lines, lambda df: profile.group_stats(df, "l_returnflag", COLUMNS)),
        "pearson_matrix": _on(lines, lambda df: correlate.pearson_matrix(df, COLUMNS, digits=4)),
        "pearson_matrix_wide": _on(meta, _meta_matrix),
        "pearson_missing": _on(documents, _pearson_missing),
        "label_corr_missing": _on(documents, _label_corr_missing),
        "describe_by_dtype": _on(documents, _describe_by_dtype, stddev=4),
        "feature_label_corr": _on(lines, _label_corr),
        "rank_importance": _on(lines, _ranked),
        "top_k": _on(lines, lambda df: evaluate.top_features(_ranked(df), 3)),
        "hash_split": _on(standins.training, _split),
        "class_distribution": _on(
            standins.training, lambda df: prepare.class_distribution(_split(df))
        ),
        "assemble_report": _on(
            documents, lambda df: prepare.assemble_report(df, ["n_chars", "toxic"], F.col("quality"))
        ),
        "build_reports": _build_reports,
        "best_models": _on(
            _two_models, lambda df: evaluate.best_models(_metrics_long(df), list(MODELS))
        ),
        "confusion_matrix": _on(standins.scored, evaluate.confusion_matrix),
        "class_metrics": _on(_two_models, lambda df: evaluate.class_metrics(df, ("model",))),
        "auc_exact": _on(standins.scored, ordered.area_under_roc, auc=10),
        "auc_by_model": _on(
            standins.scored_by_ranges, lambda df: ordered.area_under_roc(df, by=("model",)), auc=10
        ),
        "metrics_long": _on(_two_models, _metrics_long),
        "model_winner": _on(
            _two_models, lambda df: evaluate.model_winner(_metrics_long(df), *MODELS)
        ),
        "exact_model_predictions": _exact_predictions,
        "exact_model_boosted": _exact_boosted,
        "exact_model_cv": _on(_exact_cv, lambda df: df),
        "exact_model_grid": _on(_exact_grid, lambda df: df),
        "exact_model_importance": _on(_exact_importance, lambda df: df),
        "prediction_totals": _on(_prediction_totals, lambda df: df),
        "importance_total": _on(_importance_total, lambda df: df),
        "rf_cv": _cross_validated(training.RANDOM_FOREST, models.random_forest),
        "gbt_cv": _cross_validated(training.BOOSTED_TREES, models.boosted_trees),
        "feature_importance": _importance,
        "predictions": _predictions,
        "model_comparison": _model_comparison,
    }


def oracle_sql() -> dict[str, str]:
    """SQL for every query that SQL can state; the trained models have none."""
    on_documents = {}
    if llm_queries:
        on_documents = {**llm_queries.oracle_sql(), "pipeline": corpus_pipeline.ORACLE_SQL}
    return {name: sql for name, sql in {**ORACLES, **on_documents}.items() if sql}
