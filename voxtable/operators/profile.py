"""Profiles of a wide table. One aggregate per profile, results as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.functions.scalars import by_column, is_missing


def dataset_shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns, one row."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def sample_rows(df: DataFrame, order_by: list[str], columns: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order (F4, B1): a top-n, not a sort of the table."""
    return df.orderBy(*order_by).limit(n).select(*columns)


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample std, min and max per column, typed, one row per column."""
    x = F.col("x")
    return by_column(
        df,
        {c: F.col(c).cast("double") for c in columns},
        [
            F.count(x).alias("count"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("stddev"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        ],
    ).na.fill(0, ["count"])


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing cells per column: NULL, or NaN in floating-point columns."""
    flags = {c: is_missing(df, c) for c in df.columns}
    return by_column(df, flags, [F.count_if("x").alias("missing")]).na.fill(0, ["missing"])


def group_frequency(df: DataFrame, by: str) -> DataFrame:
    """Rows per group and their percentage of all rows, most frequent first.

    The total is a scalar subquery over the grouped counts, not a window over all groups, so a
    column with very many values stays distributed.
    """
    counts = df.groupBy(by).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    percent = F.round(F.col("count") / total * 100, 1)
    return counts.withColumn("percent", percent).orderBy(F.desc("count"), F.col(by))


def group_stats(df: DataFrame, by: str, columns: list[str], digits: int | None = 2) -> DataFrame:
    """avg / std (sample) / max / min of each column per group, ordered by group.

    Aggregated long, one row per group and column, and widened afterwards.
    """

    def shown(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    stats = {"avg": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}
    values = {c: F.col(c).cast("double") for c in columns}
    aggregates = [shown(fn("x")).alias(s) for s, fn in stats.items()]
    cells = by_column(df, values, aggregates, keep=(by,))
    widened = [
        F.max(F.when(F.col("column") == c, F.col(s))).alias(f"{s}_{c}")
        for s in stats
        for c in columns
    ]
    return cells.groupBy(by).agg(*widened).orderBy(by)
