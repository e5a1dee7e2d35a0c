"""Features and profiles that need only the slice-metadata table.

Input: one row per slice ``(volume_id, slice, n0, n1, n2)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.functions.scalars import any_positive, safe_ratio


def volume_metadata(slice_meta: DataFrame) -> DataFrame:
    """One row per volume: channel sums, ratios and extent of the active slices.

    A single conditional aggregate: the filtered aggregate never has to be joined back, and
    partial aggregation keeps a volume with very many slices harmless. Volumes without an active
    slice get count 0 and extent -1.
    """
    counts = [F.col(f"n{c}") for c in range(3)]
    active_slice = F.when(any_positive(counts), F.col("slice"))
    sums = slice_meta.where(F.col("volume_id").isNotNull()).groupBy("volume_id").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(f"voxels_ch{c}") for c, n in enumerate(counts)],
        F.count(active_slice).alias("tumour_slice_count"),
        F.coalesce(F.min(active_slice), F.lit(-1)).cast("bigint").alias("start_slice"),
        F.coalesce(F.max(active_slice), F.lit(-1)).cast("bigint").alias("end_slice"),
    )
    voxels = [F.col(f"voxels_ch{c}") for c in range(3)]
    total = voxels[0] + voxels[1] + voxels[2]
    return sums.select(
        "volume_id",
        *voxels,
        total.alias("total_tumour_voxels"),
        *[safe_ratio(v, total).alias(f"ratio_ch{c}") for c, v in enumerate(voxels)],
        "tumour_slice_count",
        "start_slice",
        "end_slice",
    )


def missing_volumes(volumes: DataFrame, slices: DataFrame) -> DataFrame:
    """Volumes of the list that have no slice at all.

    The slice side is reduced to distinct ids first, so that the shuffle carries each id once
    per map task however many slices a volume has; the join reuses that partitioning.
    """
    present = slices.select("volume_id").distinct()
    return volumes.join(present, "volume_id", "left_anti")


def volume_ids_of_both(first: DataFrame, second: DataFrame) -> DataFrame:
    """Distinct ids of the volumes that have slices in both tables; NULL is no id."""
    ids = [df.select("volume_id").distinct() for df in (first, second)]
    return ids[0].join(ids[1], "volume_id", "left_semi")


def slices_per_volume(slices: DataFrame) -> DataFrame:
    return slices.groupBy("volume_id").agg(F.count("*").alias("n_slices"))


def volume_slice_stats(slices: DataFrame) -> DataFrame:
    """Number of volumes and min / max / mean of their slice counts, one row."""
    return slices_per_volume(slices).agg(
        F.count("*").alias("n_volumes"),
        F.min("n_slices").alias("min_slices"),
        F.max("n_slices").alias("max_slices"),
        F.round(F.avg("n_slices"), 1).alias("mean_slices"),
    )


def volume_ids(slices: DataFrame) -> DataFrame:
    """Distinct volume ids in ascending order."""
    return slices.select("volume_id").distinct().orderBy("volume_id")
