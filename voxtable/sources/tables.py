"""Reading and writing the tables around the volumes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtable.schemas import SLICE_META, clean_table_schema, feature_table_schema


# How CSV is read and written: quotes are doubled inside quotes, and a row of another width than the
# header fails whichever columns are asked for.
QUOTING = {"quote": '"', "escape": '"'}
READING = {
    **QUOTING,
    "header": True,
    "enforceSchema": False,
    "mode": "FAILFAST",
    "columnPruning": False,
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """CSV with a header that has to match the schema; a malformed cell fails the read (A1, A2).

    A large file is read in as many tasks as it has splits. ``multi_line`` allows line breaks in
    quoted cells, for which one task has to read a file from its start to its end; without it such
    a row has the wrong width and fails.
    """
    return spark.read.options(**READING, multiLine=multi_line).schema(schema).csv(path)


def read_columns(
    spark: SparkSession,
    path: str,
    columns: dict[str, tuple[str, str]],
    multi_line: bool = False,
) -> DataFrame:
    """Some columns of a CSV file, found by header name.

    ``columns`` maps an output name to (header name, type). No inference pass is run. A row with
    too few or too many cells fails the read, a cell that does not fit its type fails the cast.
    ``multi_line`` is that of ``read_csv``.
    """
    text = spark.read.options(**READING, multiLine=multi_line).csv(path)
    return text.select(*[F.col(f"`{h}`").cast(t).alias(c) for c, (h, t) in columns.items()])


# Header names of the slice-metadata file, in the order of ``SLICE_META``.
SLICE_META_HEADERS = ("volume", "slice", "label0_pxl_cnt", "label1_pxl_cnt", "label2_pxl_cnt")


def read_slice_meta(spark: SparkSession, path: str) -> DataFrame:
    """Slice-metadata CSV as ``(volume_id, slice, n0, n1, n2)``; no cell holds a line break."""
    columns = {
        f.name: (header, f.dataType.simpleString())
        for f, header in zip(SLICE_META, SLICE_META_HEADERS)
    }
    return read_columns(spark, path, columns)


def read_name_map(
    spark: SparkSession,
    path: str,
    subject_header: str,
    label_header: str = "Grade",
    multi_line: bool = True,
) -> DataFrame:
    """Label map CSV as ``(subject_id, grade)``."""
    columns = {"subject_id": (subject_header, "string"), "grade": (label_header, "string")}
    return read_columns(spark, path, columns, multi_line)


def read_attribute(
    spark: SparkSession,
    path: str,
    subject_header: str,
    value_header: str = "Age",
    multi_line: bool = True,
) -> DataFrame:
    """Attribute CSV as ``(subject_id, age)``."""
    columns = {"subject_id": (subject_header, "string"), "age": (value_header, "double")}
    return read_columns(spark, path, columns, multi_line)


def read_feature_table(
    spark: SparkSession, path: str, subject_column: str = "subject_id"
) -> DataFrame:
    return read_csv(spark, path, feature_table_schema(subject_column))


def read_clean_table(
    spark: SparkSession, path: str, subject_column: str = "subject_id"
) -> DataFrame:
    return read_csv(spark, path, clean_table_schema(subject_column))


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, replacing what is there.

    ``single_file`` funnels the table through one task: for small result tables only.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**QUOTING).csv(path, header=True)


def work_folder(spark: SparkSession) -> str:
    """A fresh path for an intermediate table, in a folder that all executors share.

    That is the folder named by ``spark.checkpoint.dir``, or the warehouse of the session where
    that is unset. Never a folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/voxtable-{uuid.uuid4().hex}"


_SCOPE: ContextVar[list[str] | None] = ContextVar("work_tables", default=None)


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialize`` writes inside are removed at the end.

    For the time until a result is written or collected; whatever is still to be read from those
    tables afterwards has to be kept. They go also when the body fails. Scopes may be nested: each
    removes its own tables.
    """
    written: list[str] = []
    token = _SCOPE.set(written)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in written:
            remove_table(spark, path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table of the work folder; one that is gone already is no error."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)


def materialize(df: DataFrame, keep: bool = False, **options: str) -> DataFrame:
    """Write a table to the work folder and read it back.

    Cuts the lineage for good, survives lost executors, and keeps column pruning and size
    statistics for whatever is built on top. Inside ``work_tables`` the table lives until the end
    of that block, unless it is to be kept; elsewhere nothing is deleted, and the work folder is
    tidied up like any checkpoint folder. ``options`` go to the Parquet writer.
    """
    path = work_folder(df.sparkSession)
    scope = _SCOPE.get()
    if scope is not None and not keep:
        scope.append(path)  # before it is written: a failed write leaves files as well
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame for several actions and release it afterwards."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()
