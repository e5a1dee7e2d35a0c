"""Exploration of the feature table: every profile as a table, then the clean table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.functions.scalars import encode_label, numeric_columns
from voxtable.operators import correlate, prepare, profile
from voxtable.schemas import CLASS_NAMES, REDUNDANT_COLUMNS
from voxtable.sources.tables import cached

# Columns shown in the sample, the summary and the per-class statistics.
SAMPLE = ("volume_id", "grade", "age", "total_tumour_voxels", "tumour_slice_count")
SUMMARY = (
    "age",
    "total_tumour_voxels",
    "tumour_slice_count",
    "flair_mean",
    "t1_mean",
    "t1ce_mean",
    "t2_mean",
)
PER_CLASS = (
    "age",
    "total_tumour_voxels",
    "tumour_slice_count",
    "ratio_ch0",
    "ratio_ch1",
    "ratio_ch2",
    "flair_mean",
    "t1_mean",
    "t1ce_mean",
    "t2_mean",
)


@contextmanager
def explore(
    features: DataFrame,
    key: str = "volume_id",
    label: str = "grade",
    positive: str = CLASS_NAMES[1],
    unmatched: str = "null",
    sample: tuple[str, ...] | None = SAMPLE,
    summary: tuple[str, ...] | None = SUMMARY,
    per_class: tuple[str, ...] | None = PER_CLASS,
    drop: tuple[str, ...] = REDUNDANT_COLUMNS,
    method: str = "listwise",
) -> Iterator[dict[str, DataFrame]]:
    """Profile tables by name. The table stays cached inside the ``with`` block.

    The defaults are those of the feature table. For another one name its key, label and columns;
    None stands for all columns in the sample, and for all numeric ones in the summary and the
    statistics per class. ``unmatched`` decides what a missing label becomes.
    """
    with cached(features) as df:
        numeric = numeric_columns(df, exclude=(key, label))
        encoded = encode_label(F.col(label), positive, unmatched)
        yield {
            "shape": profile.dataset_shape(df),
            "sample": profile.sample_rows(df, [key], list(sample or df.columns)),
            "summary": profile.describe_numeric(df, list(summary or numeric)),
            "missing": profile.missing_counts(df),
            "class_frequency": profile.group_frequency(df, label),
            "class_stats": profile.group_stats(df, label, list(per_class or numeric)),
            "correlation": correlate.pearson_matrix(df, numeric, method),
            "label_correlation": correlate.feature_label_corr(df, numeric, encoded),
            "clean": prepare.clean_features(df, drop, label, positive, unmatched),
        }
