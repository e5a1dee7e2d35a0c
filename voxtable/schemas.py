"""Schemas of the tables that the operators read and write.

Sums of counts are ``bigint`` and every statistic is ``double``: both have to survive inputs
far larger than one data set's worth of volumes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Names of the image modalities and of the statistics kept for each of them.
MODALITIES = ("flair", "t1", "t1ce", "t2")
INTENSITY_STATS = ("mean", "std", "min", "max", "skewness")

# Class names by label value, 0 first.
CLASS_NAMES = ("LGG", "HGG")

# Columns dropped from the feature table before training.
REDUNDANT_COLUMNS = (
    "voxels_ch0",
    "voxels_ch1",
    "voxels_ch2",
    "t2_max",
    "end_slice",
    "t1_max",
    "spread_x",
    "spread_y",
    "t1_skewness",
    "tumour_slice_count",
    "start_slice",
)


@dataclass(frozen=True)
class TensorLayout:
    """How the flat ``image`` and ``mask`` arrays of a slice are laid out.

    Both are height-width-channel arrays in C order. Pixel ``p`` holds modality ``m`` at
    ``image[p * len(modalities) + m]`` and mask channel ``c`` at ``mask[p * channels + c]``.
    """

    modalities: tuple[str, ...] = MODALITIES
    channels: int = 3

    @classmethod
    def of_width(cls, modalities: int, channels: int = 3) -> TensorLayout:
        """Layout with ``modalities`` image channels; the ones without a name become ``mod<i>``."""
        names = [MODALITIES[i] if i < len(MODALITIES) else f"mod{i}" for i in range(modalities)]
        return cls(tuple(names), channels)

    @property
    def intensity_columns(self) -> list[str]:
        return [f"{m}_{s}" for m in self.modalities for s in INTENSITY_STATS]

    @property
    def pairs(self) -> list[tuple[int, int]]:
        return [(a, b) for a in range(self.channels) for b in range(a + 1, self.channels)]


SPATIAL_COLUMNS = [f"{g}_{axis}" for g in ("centroid", "spread") for axis in ("x", "y", "slice")]
EXTENT_COLUMNS = ["tumour_slice_count", "start_slice", "end_slice"]
METADATA_COLUMNS = [
    "volume_id",
    "voxels_ch0",
    "voxels_ch1",
    "voxels_ch2",
    "total_tumour_voxels",
    "ratio_ch0",
    "ratio_ch1",
    "ratio_ch2",
    *EXTENT_COLUMNS,
]


def _struct(columns: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


SLICE_META = _struct(
    [
        ("volume_id", T.LongType()),
        ("slice", T.IntegerType()),
        ("n0", T.LongType()),
        ("n1", T.LongType()),
        ("n2", T.LongType()),
    ]
)

TENSOR_SLICES = _struct(
    [
        ("volume_id", T.LongType()),
        ("slice_idx", T.LongType()),
        ("h", T.IntegerType()),
        ("w", T.IntegerType()),
        ("image", T.ArrayType(T.FloatType())),
        ("mask", T.ArrayType(T.ByteType())),
    ]
)


def feature_table_schema(subject_column: str = "subject_id") -> T.StructType:
    """The 40 columns of the feature table, in file order."""
    integral = {c for c in METADATA_COLUMNS if not c.startswith("ratio_")}
    numeric = METADATA_COLUMNS + TensorLayout().intensity_columns + SPATIAL_COLUMNS
    columns = [(c, T.LongType() if c in integral else T.DoubleType()) for c in numeric]
    tail = [(subject_column, T.StringType()), ("grade", T.StringType()), ("age", T.DoubleType())]
    return _struct(columns + tail)


def clean_table_schema(subject_column: str = "subject_id") -> T.StructType:
    """The 29 columns left after dropping ``REDUNDANT_COLUMNS``, with ``grade`` as 0/1."""
    kept = [f for f in feature_table_schema(subject_column) if f.name not in REDUNDANT_COLUMNS]
    return T.StructType(
        [T.StructField("grade", T.IntegerType()) if f.name == "grade" else f for f in kept]
    )
