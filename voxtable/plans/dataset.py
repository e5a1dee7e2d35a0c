"""From raw tables to the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.operators import enrich, metadata, tensors
from voxtable.schemas import TensorLayout, feature_table_schema
from voxtable.sources.tables import materialize


def build_reported(
    slice_meta: DataFrame,
    tensor_slices: DataFrame,
    name_map: DataFrame,
    attributes: DataFrame,
    id_pattern: str = r"_(\d+)$",
    layout: TensorLayout | None = None,
    approx_median: bool = False,
    strict: bool = True,
    whole_mask: str = "union",
    fit_where: Column | None = None,
) -> dict[str, DataFrame]:
    """The feature table and what happened on the way, by name.

    ``features`` has one row per volume with slices: counts, tensor statistics, label, imputed
    attribute. ``label_coverage``, ``label_frequencies`` and ``attribute_coverage`` describe its
    rows before the attribute is imputed, ``skipped_volumes`` the volumes without tensor slices,
    ``rows_without_volume`` the input rows that have no volume id.

    The median is taken over the ids of the volumes and their attributes, which are written to the
    work folder, so that neither the tensors nor the joined table are read for it. ``fit_where`` limits it to some volumes, those of
    the training split, say. ``strict`` refuses subjects without a number at the end of their name;
    ``whole_mask`` is that of ``volume_features``.
    """
    layout = layout or TensorLayout()
    volumes = metadata.volume_metadata(slice_meta)
    statistics = tensors.volume_features(tensor_slices, layout, whole_mask).select(
        "volume_id", *layout.intensity_columns, *tensors.SPATIAL_COLUMNS
    )

    def completed(df: DataFrame) -> DataFrame:
        labelled = enrich.attach_label(df, name_map, id_pattern=id_pattern, strict=strict)
        return enrich.attach_attribute(labelled, attributes)

    ids = metadata.volume_ids_of_both(slice_meta, tensor_slices)
    # One small row for each volume, which the median reads several times over.
    known = materialize(completed(ids))
    fitted = known if fit_where is None else known.where(fit_where)
    joined = completed(enrich.merge_features(volumes, statistics))
    imputed = enrich.impute_median(joined, "age", approx_median, fit_on=fitted)
    if layout == TensorLayout():
        imputed = imputed.select(*feature_table_schema().names)
    without = [
        df.where(F.col("volume_id").isNull()).agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("input"), "n_rows"
        )
        for name, df in (("slice_meta", slice_meta), ("tensor_slices", tensor_slices))
    ]
    return {
        "features": imputed,
        "label_coverage": enrich.coverage(known, "grade"),
        "label_frequencies": enrich.label_frequencies(known),
        "attribute_coverage": enrich.coverage(known, "age"),
        "skipped_volumes": skipped_volumes(slice_meta, tensor_slices),
        "rows_without_volume": without[0].unionByName(without[1]),
    }


def build_feature_table(
    slice_meta: DataFrame,
    tensor_slices: DataFrame,
    name_map: DataFrame,
    attributes: DataFrame,
    **switches,
) -> DataFrame:
    """The feature table alone, with the switches of ``build_reported``."""
    return build_reported(slice_meta, tensor_slices, name_map, attributes, **switches)["features"]


def skipped_volumes(slice_meta: DataFrame, tensor_slices: DataFrame) -> DataFrame:
    """Volumes with metadata but without tensor slices, which the feature table leaves out."""
    return metadata.missing_volumes(slice_meta.select("volume_id").distinct(), tensor_slices)
