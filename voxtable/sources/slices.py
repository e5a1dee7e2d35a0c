"""Tensor slices: stored tables, and the names in one-file-per-slice folders."""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtable.functions.scalars import slice_file_ids
from voxtable.schemas import TENSOR_SLICES


def read_tensor_slices(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table of slices, see ``TENSOR_SLICES`` (A4)."""
    return spark.read.schema(TENSOR_SLICES).parquet(path)


def binarised(mask: Column | str, threshold: float = 0.0) -> Column:
    """Mask values above the threshold as 1, the others as 0."""
    return F.transform(mask, lambda v: (v > threshold).cast("tinyint"))


def list_slice_files(spark: SparkSession, folder: str, pattern: str = "*.h5") -> DataFrame:
    """``(path, volume_id, slice_idx)`` of the slice files in a folder.

    The listing is split over tasks by file size; file contents are not read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    volume_id, slice_idx = slice_file_ids(F.col("path"))
    return files.select("path", volume_id.alias("volume_id"), slice_idx.alias("slice_idx"))


def _uri(path: str) -> str:
    """A path as Spark shows it (``file:/x``) in the form that file systems are found by."""
    local = path.removeprefix("file:")
    return path if local == path else "file:///" + local.lstrip("/")


def stored_types(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """``(path, image_type, mask_type, n_slices)`` of the Parquet files in a folder.

    The types of the arrays as they are stored, which may differ from file to file, so that a table
    of them all cannot be read. Tasks read the footers of their files and nothing else; a file
    without one of the columns has NULL for its type.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    names = ["path", "image_type", "mask_type", "n_slices"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                system, local = fs.FileSystem.from_uri(_uri(path))
                with pq.ParquetFile(local, filesystem=system) as file:
                    types = {f.name: _element(f.type) for f in file.schema_arrow}
                    rows.append((path, types.get("image"), types.get("mask"), file.metadata.num_rows))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] * 3 + [pa.int64()])]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "path string, image_type string, mask_type string, n_slices bigint"
    return files.select("path").mapInArrow(read, schema)


def _element(kind: pa.DataType) -> str:
    return str(kind.value_type if pa.types.is_list(kind) else kind)


def type_census(types: DataFrame) -> DataFrame:
    """How many slices are stored with which types; more than one row means mixed files."""
    return types.groupBy("image_type", "mask_type").agg(F.sum("n_slices").alias("n_slices"))


def files_of_other_types(types: DataFrame) -> DataFrame:
    """The files whose types are not those that most slices have (D26); of equal ones the first."""
    census = type_census(types).orderBy(F.desc("n_slices"), "image_type", "mask_type")
    most = census.limit(1).select(F.struct("image_type", "mask_type")).scalar()
    return types.where(~F.struct("image_type", "mask_type").eqNullSafe(most))


def write_slice_files(slices: DataFrame, folder: str) -> None:
    """One ``volume_<id>_slice_<idx>.npz`` for each slice, with arrays ``image`` and ``mask``.

    For tools that want a file for each slice. Tasks write to ``folder``, which all of them must see;
    a task that runs again writes the same files again. Slices of the same volume and index are one
    file.
    """
    uri = _uri(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(uri)
        files.create_dir(path, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                content = io.BytesIO()
                image = np.array(row["image"], np.float32).reshape(row["h"], row["w"], -1)
                mask = np.array(row["mask"], np.int8).reshape(row["h"], row["w"], -1)
                np.savez(content, image=image, mask=mask)
                name = f"volume_{row['volume_id']}_slice_{row['slice_idx']}.npz"
                with files.open_output_stream(f"{path}/{name}") as out:
                    out.write(content.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    slices.select(*TENSOR_SLICES.names).mapInArrow(write, "n bigint").agg(F.sum("n")).collect()


def write_clustered(
    slices: DataFrame,
    path: str,
    buckets: int,
    order: str = "slice_idx",
    rows_per_file: int = 100_000,
) -> None:
    """Store a table of slices by volume: ``buckets`` buckets, sorted by volume and ``order`` (A4).

    A bucket is one file of up to ``rows_per_file`` rows; a larger one, that of a volume with a third
    of all slices, say, is dealt to as many files, each written by a task of its own. One pass counts
    the rows of every bucket, for that. Replaces what is there.
    """
    spark = slices.sparkSession
    bucket = F.pmod(F.hash("volume_id"), F.lit(buckets))  # what Spark's bucketing computes
    counts = slices.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).collect()
    files = {r.bucket: -(-r.n // rows_per_file) for r in counts}  # a row for each bucket
    firsts = dict(zip(files, accumulate([0, *files.values()])))
    places = [F.struct(F.lit(firsts.get(b, 0)).alias("first"), F.lit(files.get(b, 1)).alias("files")) for b in range(buckets)]
    place = F.get(F.array(*places), F.col("bucket"))
    dealt = slices.withColumn("bucket", bucket).withColumn("place", place)
    target = F.col("place.first") + F.pmod(F.xxhash64(order), F.col("place.files"))
    total = max(1, sum(files.values()))
    placed = dealt.repartitionById(total, target.cast("int")).select(*slices.columns)
    name = f"clustered_{uuid.uuid4().hex}"
    written = placed.write.format("parquet").mode("overwrite").option("path", path)
    written.bucketBy(buckets, "volume_id").sortBy("volume_id", order).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is an external one


def read_clustered(
    spark: SparkSession,
    path: str,
    buckets: int,
    schema: T.StructType = TENSOR_SLICES,
    order: str = "slice_idx",
    max_bucket_bytes: int = 1 << 30,
) -> DataFrame:
    """The table that ``write_clustered`` has stored under ``path`` with as many buckets (A4).

    A filter on the volume reads the files of one bucket. Aggregates by volume, and joins with a
    table stored by as many buckets, need no exchange, since a task reads whole buckets. Where one is
    larger than ``max_bucket_bytes`` (the volumes are too uneven for that), files are split among
    tasks as usual; results are the same.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    bucket = F.regexp_extract("path", r"_(\d+)(?:\.c\d+)?\.[^/]*$", 1)
    largest = files.groupBy(bucket).agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    if (largest or 0) > max_bucket_bytes:
        return spark.read.schema(schema).parquet(path)
    name = f"clustered_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet "
        f"CLUSTERED BY (volume_id) SORTED BY (volume_id, {order}) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(name)
