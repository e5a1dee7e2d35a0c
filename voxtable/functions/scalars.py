"""Column expressions shared by the operators. All of them are JVM built-ins."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0.0 where the whole is zero or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def any_positive(columns: list[Column]) -> Column:
    """True when at least one column is above zero; missing values count as not positive."""
    return reduce(or_, [F.coalesce(c > 0, F.lit(False)) for c in columns])


def trailing_id(column: Column, pattern: str = r"_(\d+)$", strict: bool = True) -> Column:
    """Integer key at the end of a name.

    Strict: a name without the pattern gives '' and the ANSI cast raises. Otherwise NULL.
    """
    digits = F.regexp_extract(column, pattern, 1)
    return digits.cast("bigint") if strict else digits.try_cast("bigint")


def slice_file_ids(path: Column) -> tuple[Column, Column]:
    """``(volume_id, slice_idx)`` out of ``.../volume_<id>_slice_<idx>.<ext>``."""
    pattern = r"(?:^|/)volume_(\d+)_slice_(\d+)\.[^/]*$"
    return tuple(F.regexp_extract(path, pattern, g).cast("bigint") for g in (1, 2))


def encode_label(label: Column, positive: str, unmatched: str = "null") -> Column:
    """1 for the positive class, 0 for the others.

    A missing label stays NULL, or becomes 0 with ``unmatched="zero"``.
    """
    if unmatched not in ("null", "zero"):
        raise ValueError(f"unmatched must be 'null' or 'zero', not {unmatched!r}")
    binary = F.when(label == positive, 1).otherwise(0)
    return binary if unmatched == "zero" else F.when(label.isNotNull(), binary)


def decode_label(value: Column, names: tuple[str, ...]) -> Column:
    """Class name of a numeric label 0, 1, ...; NULL for any other value."""
    return reduce(
        lambda chain, item: chain.when(value == float(item[0]), item[1]),
        list(enumerate(names))[1:],
        F.when(value == 0.0, names[0]),
    )


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def all_present(df: DataFrame, names: list[str]) -> Column:
    """True for rows with all of the columns. Few are single conditions, which can be pushed down;
    many are one, since a plan with thousands of nested ones is too deep."""
    if len(names) > 100:
        return ~F.exists(F.array(*[is_missing(df, n) for n in names]), lambda missing: missing)
    return reduce(and_, [~is_missing(df, n) for n in names], F.lit(True))


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of the numeric columns in schema order, without the excluded ones."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def hash_bucket(key: Column, buckets: int, seed: int, part: int = 0) -> Column:
    """Bucket 0..buckets-1 of a key, the same in any partitioning and any engine with md5 (H2).

    ``part`` picks one of four 32-bit slices of the digest; different parts are independent.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("bigint") % buckets).cast(
        "int"
    )


def by_column(
    df: DataFrame,
    values: dict[str, Column],
    aggregates: list[Column],
    keep: tuple[str, ...] = (),
    y: Column | None = None,
) -> DataFrame:
    """The same aggregates of ``x`` for every named value: ``(*keep, column, *aggregates)``.

    The values of a row become one array that is exploded and grouped by position. That keeps the
    generated code the same size for any number of columns, where a wide aggregate over forty
    columns outgrows the JIT, and partial aggregation leaves one row per column and task. All
    values must have one type. Ungrouped, every column has its row even for an empty table. The
    aggregates may also use ``y``, a double that is the same for all values of a row.
    """
    y = (F.lit(None) if y is None else y).cast("double").alias("y")
    long = df.select(*keep, y, F.posexplode(F.array(*values.values())).alias("position", "x"))
    grouped = long.groupBy(*keep, "position").agg(*aggregates)
    stats = [c for c in grouped.columns if c not in (*keep, "position")]
    names = F.array(*[F.lit(n) for n in values])
    if keep:
        return grouped.select(*keep, F.get(names, F.col("position")).alias("column"), *stats)
    columns = df.sparkSession.range(1).select(F.posexplode(names).alias("position", "column"))
    return columns.join(grouped, "position", "left").select("column", *stats)


def long_rows(rows: list[tuple[Column, ...]], names: list[str]) -> Column:
    """Explode a fixed list of column tuples into rows: ``df.select(long_rows(...))``."""
    return F.inline(
        F.array(*[F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows])
    )
