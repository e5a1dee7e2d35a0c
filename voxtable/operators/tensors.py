"""Masked statistics over tensor slices.

Input: one row per slice ``(volume_id, slice_idx, h, w, image, mask)``; see ``TensorLayout``.

Everything that looks at pixels starts from ``pixel_rows``: pixels are generated inside
whole-stage codegen, inactive ones are filtered away before any aggregate sees them, and only
partial aggregates (one row per task and volume) are shuffled. No volume is ever gathered in one
place, so a volume that holds a third of all slices costs no more than any other third.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.functions.scalars import long_rows, safe_ratio
from voxtable.schemas import (
    EXTENT_COLUMNS,
    INTENSITY_STATS,
    SPATIAL_COLUMNS,
    TensorLayout,
)

_DEFAULT = TensorLayout()


def has_active_pixel(mask: Column | str = "mask") -> Column:
    """True when any element of the mask is above zero; false for an empty mask."""
    return F.coalesce(F.array_max(mask) > 0, F.lit(False))


def pixel_rows(slices: DataFrame, layout: TensorLayout = _DEFAULT) -> DataFrame:
    """One header row per slice plus one row per active pixel.

    The header (``pos`` = -1) keeps slices and volumes without any active pixel in the result,
    so that no join back to the list of volumes is needed. Its coordinates, mask flags and
    values are NULL and drop out of every aggregate. A slice without an active pixel generates
    nothing but its header. A mask of the wrong size is an error, and so is an image of the wrong
    size or none where a value of it is asked for.

    Columns: volume_id, slice_idx, slice_active, pos, y, x, active_<c> per mask channel,
    v_<modality>.
    """
    expected = F.col("h") * F.col("w") * layout.channels
    last = (
        F.when(~F.col("slice_active"), -1)
        .when(F.size("mask") == expected, F.col("h") * F.col("w") - 1)
        .otherwise(F.raise_error(F.lit("mask size differs from h * w * channels")).cast("int"))
    )
    wrong = F.raise_error(F.lit("image size differs from h * w * modalities"))
    right = F.size("image") == F.col("h") * F.col("w") * len(layout.modalities)
    generated = (
        slices.withColumn("slice_active", has_active_pixel())
        .withColumn("image", F.when(right, F.col("image")).otherwise(wrong.cast("array<float>")))
        .withColumn("pos", F.explode(F.sequence(F.lit(-1), last)))
    )

    pos, pixel = F.col("pos"), F.col("pos") >= 0
    flags = [
        F.when(pixel, F.coalesce(F.get("mask", pos * layout.channels + c) > 0, F.lit(False)))
        for c in range(layout.channels)
    ]
    values = [
        F.when(pixel, F.col("image")[pos * len(layout.modalities) + m].cast("double"))
        for m in range(len(layout.modalities))
    ]
    return generated.where((pos == -1) | reduce(or_, flags)).select(
        "volume_id",
        "slice_idx",
        "slice_active",
        "pos",
        F.when(pixel, F.expr("cast(pos div w as int)")).alias("y"),
        F.when(pixel, pos % F.col("w")).alias("x"),
        *[f.alias(f"active_{c}") for c, f in enumerate(flags)],
        *[v.alias(f"v_{m}") for m, v in zip(layout.modalities, values)],
    )


def volume_features(
    slices: DataFrame, layout: TensorLayout = _DEFAULT, whole_mask: str = "union"
) -> DataFrame:
    """All tensor features of a volume in one row: one scan, one shuffle.

    Groups: voxel counts and ratios per mask channel; mean, population std, min, max and
    population skewness per modality; centroid and population spread; extent of the active
    slices. ``total_tumour_voxels`` counts pixels with any active channel (``union``) or adds up
    the channels (``sum``); the ratios are always relative to that sum, so they add up to 1.

    Slices without a volume id are left out, as those of the metadata are. A volume without active
    pixels gets 0.0 statistics; a single voxel or equal values keep the NULL skewness. Selecting one
    group lets Catalyst prune the aggregates and the scan columns of the others.
    """
    if whole_mask not in ("union", "sum"):
        raise ValueError(f"whole_mask must be 'union' or 'sum', not {whole_mask!r}")
    header, pixel = F.col("pos") == -1, F.col("pos") >= 0
    active_slice = F.when(header & F.col("slice_active"), F.col("slice_idx"))
    place = {"x": F.col("x"), "y": F.col("y"), "slice": F.when(pixel, F.col("slice_idx"))}

    intensity = []
    for m in layout.modalities:
        v = F.col(f"v_{m}")
        intensity += [
            F.avg(v).alias(f"{m}_mean"),
            F.stddev_pop(v).alias(f"{m}_std"),
            F.min(v).alias(f"{m}_min"),
            F.max(v).alias(f"{m}_max"),
            F.skewness(v).alias(f"{m}_skewness"),
        ]
    sums = (
        pixel_rows(slices.where(F.col("volume_id").isNotNull()), layout)
        .groupBy("volume_id")
        .agg(
            F.count_if(header).alias("n_slices"),
            F.count(active_slice).alias("tumour_slice_count"),
            F.coalesce(F.min(active_slice), F.lit(-1)).alias("start_slice"),
            F.coalesce(F.max(active_slice), F.lit(-1)).alias("end_slice"),
            F.count_if(pixel).alias("union_voxels"),
            *[
                F.count_if(F.col(f"active_{c}")).alias(f"voxels_ch{c}")
                for c in range(layout.channels)
            ],
            *intensity,
            *[F.avg(v.cast("double")).alias(f"centroid_{a}") for a, v in place.items()],
            *[F.stddev_pop(v.cast("double")).alias(f"spread_{a}") for a, v in place.items()],
        )
    )
    voxels = [F.col(f"voxels_ch{c}") for c in range(layout.channels)]
    summed = reduce(lambda a, b: a + b, voxels)
    empty = F.col("union_voxels") == 0
    return sums.select(
        "volume_id",
        "n_slices",
        *voxels,
        (F.col("union_voxels") if whole_mask == "union" else summed).alias("total_tumour_voxels"),
        *[safe_ratio(v, summed).alias(f"ratio_ch{c}") for c, v in enumerate(voxels)],
        *EXTENT_COLUMNS,
        *[
            F.when(empty, 0.0).otherwise(F.col(c)).alias(c)
            for c in [*layout.intensity_columns, *SPATIAL_COLUMNS]
        ],
    )


def intensity_features_wide(slices: DataFrame, layout: TensorLayout = _DEFAULT) -> DataFrame:
    """Intensity statistics as ``<modality>_<stat>`` columns, one row per volume."""
    return volume_features(slices, layout).select("volume_id", *layout.intensity_columns)


def intensity_features(slices: DataFrame, layout: TensorLayout = _DEFAULT) -> DataFrame:
    """Intensity statistics, one row per volume and modality.

    The rows are unfolded from the wide aggregate, after the shuffle: pixels are generated once
    instead of once per modality.
    """
    rows = [
        (F.lit(m), *[F.col(f"{m}_{s}") for s in INTENSITY_STATS]) for m in layout.modalities
    ]
    return intensity_features_wide(slices, layout).select(
        "volume_id", long_rows(rows, ["modality", *INTENSITY_STATS])
    )


def spatial_features(slices: DataFrame, layout: TensorLayout = _DEFAULT) -> DataFrame:
    """Centroid and population spread of the active pixels on x, y and slice."""
    return volume_features(slices, layout).select("volume_id", *SPATIAL_COLUMNS)


def slice_extent(slices: DataFrame) -> DataFrame:
    """Number, first and last index of the slices with an active pixel (D13); no pixel rows."""
    active = F.when(has_active_pixel(), F.col("slice_idx"))
    return slices.groupBy("volume_id").agg(
        F.count(active).alias("tumour_slice_count"),
        F.coalesce(F.min(active), F.lit(-1)).alias("start_slice"),
        F.coalesce(F.max(active), F.lit(-1)).alias("end_slice"),
    )


def first_active_slice(slices: DataFrame) -> DataFrame:
    """Lowest slice index with an active pixel per volume, NULL if there is none."""
    return slices.groupBy("volume_id").agg(
        F.min(F.when(has_active_pixel(), F.col("slice_idx"))).alias("first_slice")
    )


def _joined(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


def mask_values_per_slice(slices: DataFrame) -> DataFrame:
    """Sorted distinct mask values of each slice, comma-joined (D15). Row by row, no shuffle."""
    return slices.select(
        "volume_id",
        "slice_idx",
        _joined(F.array_sort(F.array_distinct("mask"))).alias("mask_values"),
    )


def _of_channel(c: int, layout: TensorLayout) -> Column:
    return F.filter("mask", lambda _, i: i % layout.channels == c)


def mask_values_per_channel(slices: DataFrame, layout: TensorLayout = _DEFAULT) -> DataFrame:
    """Sorted distinct mask values per slice and channel, comma-joined (D16). No shuffle."""

    def values(c: int) -> Column:
        return _joined(F.array_sort(F.array_distinct(_of_channel(c, layout))))

    rows = [(F.lit(c), values(c)) for c in range(layout.channels)]
    return slices.select("volume_id", "slice_idx", long_rows(rows, ["channel", "mask_values"]))


def _bitmap(values: Column) -> list[Column]:
    """The distinct values of a ``tinyint`` array as bits of four 64-bit words."""
    distinct = F.array_distinct(values)

    def word(w: int) -> Column:
        def with_bit(bits: Column, v: Column) -> Column:
            at = v.cast("int") + 128 - 64 * w
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at)
            return F.when(at.between(0, 63), bits.bitwiseOR(bit)).otherwise(bits)

        return F.aggregate(distinct, F.lit(0).cast("bigint"), with_bit)

    return [word(w) for w in range(4)]


def _of_bitmap(words: list[Column]) -> Column:
    """The values whose bits are set, in ascending order."""
    values = F.sequence(F.lit(-128), F.lit(127))
    word, place = (lambda v: F.floor((v + 128) / 64).cast("int")), lambda v: F.pmod(v + 128, F.lit(64))
    held = F.filter(values, lambda v: F.getbit(F.get(F.array(*words), word(v)), place(v)) == 1)
    return _joined(held)


def mask_values(
    slices: DataFrame,
    by: tuple[str, ...] = ("volume_id",),
    per_channel: bool = False,
    layout: TensorLayout = _DEFAULT,
) -> DataFrame:
    """Sorted distinct mask values over all slices of a group, comma-joined.

    ``by`` may be the volume, several columns, or empty for the whole table; ``per_channel`` tells
    the channels apart. A slice becomes a bitmap over the 256 values a mask can have, and bitmaps are
    merged before the exchange: what is shuffled is four numbers a task, group and channel, however
    many slices a group has. Empty masks and missing values add nothing.
    """
    if per_channel:
        rows = [(F.lit(c), *_bitmap(_of_channel(c, layout))) for c in range(layout.channels)]
        names = ["channel", *[f"w{i}" for i in range(4)]]
        bits, keys = slices.select(*by, long_rows(rows, names)), [*by, "channel"]
    else:
        words = [w.alias(f"w{i}") for i, w in enumerate(_bitmap(F.col("mask")))]
        bits, keys = slices.select(*by, *words), list(by)
    merged = bits.groupBy(*keys).agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])
    found = [F.coalesce(F.col(f"w{i}"), F.lit(0).cast("bigint")) for i in range(4)]
    return merged.select(*keys, _of_bitmap(found).alias("mask_values"))


def channel_counts(
    slices: DataFrame,
    layout: TensorLayout = _DEFAULT,
    by: tuple[str, ...] = ("volume_id", "slice_idx"),
) -> DataFrame:
    """Active pixels per channel, pairwise overlaps, union and sum in one pass.

    ``by`` may be the slice, the volume, or empty for totals. ``disjoint`` tells whether no pixel
    is active in two channels.
    """
    active = [F.col(f"active_{c}") for c in range(layout.channels)]
    pixels = pixel_rows(slices, layout)
    counts = pixels.groupBy(*by).agg(
        *[F.count_if(a).alias(f"active_ch{c}") for c, a in enumerate(active)],
        *[F.count_if(active[a] & active[b]).alias(f"overlap_ch{a}_ch{b}") for a, b in layout.pairs],
        F.count_if(F.col("pos") >= 0).alias("union_pixels"),
    )
    total = reduce(lambda a, b: a + b, [F.col(f"active_ch{c}") for c in range(layout.channels)])
    return counts.withColumn("sum_pixels", total).withColumn(
        "disjoint", F.col("union_pixels") == F.col("sum_pixels")
    )


def active_pixels(
    slices: DataFrame, slice_idxs: list[int] | None = None, layout: TensorLayout = _DEFAULT
) -> DataFrame:
    """Active pixels per channel of each slice, or of the chosen slice indices."""
    chosen = slices if slice_idxs is None else slices.where(F.col("slice_idx").isin(slice_idxs))
    return channel_counts(chosen, layout).select(
        "volume_id", "slice_idx", *[f"active_ch{c}" for c in range(layout.channels)]
    )


def channel_overlap(
    slices: DataFrame, layout: TensorLayout = _DEFAULT, by: tuple[str, ...] = ()
) -> DataFrame:
    """Pixels active in both channels of each pair, long form."""
    rows = [(F.lit(f"ch{a} & ch{b}"), F.col(f"overlap_ch{a}_ch{b}")) for a, b in layout.pairs]
    return channel_counts(slices, layout, by).select(*by, long_rows(rows, ["pair", "pixels"]))


def channel_disjoint(
    slices: DataFrame,
    layout: TensorLayout = _DEFAULT,
    by: tuple[str, ...] = ("volume_id",),
) -> DataFrame:
    """Union and per-channel sum of active pixels, and whether they agree."""
    return channel_counts(slices, layout, by).select(
        *by, "union_pixels", "sum_pixels", "disjoint"
    )


def tensor_shape_census(slices: DataFrame) -> DataFrame:
    """How many slices have which array sizes (D26); more than one row means ragged input."""
    return (
        slices.select(
            "h",
            "w",
            F.size("image").alias("image_size"),
            F.size("mask").alias("mask_size"),
        )
        .groupBy("h", "w", "image_size", "mask_size")
        .agg(F.count("*").alias("n_slices"))
    )
