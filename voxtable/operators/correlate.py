"""Pearson correlations between columns, and of columns with a label."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.functions.scalars import all_present, by_column, is_missing
from voxtable.ship import ship_package


def _pearson() -> Column:
    """Correlation of ``x`` and ``y`` over the rows with both; NULL for a constant one.

    ``corr`` raises a division by zero for a constant column under ANSI, hence the parts.
    """
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    x, y, zero = F.when(both, F.col("x")), F.when(both, F.col("y")), F.lit(0.0)
    deviations = F.nullif(F.stddev_pop(x), zero) * F.nullif(F.stddev_pop(y), zero)
    return (F.covar_pop(x, y) / deviations).alias("corr")


def _present(df: DataFrame, column: str) -> Column:
    return F.when(~is_missing(df, column), F.col(column).cast("double"))


def pearson_matrix(
    df: DataFrame, columns: list[str], method: str = "listwise", digits: int | None = 2
) -> DataFrame:
    """Correlation matrix in long form ``(feature_a, feature_b, corr)``, every cell.

    ``listwise`` drops a row with any missing cell; ``pairwise`` uses every row in which both
    columns are present. Cells with fewer than two rows or a constant column are NULL, the
    diagonal is 1.

    One scan takes mean, deviation and range of every column; then the products of standardised
    values are added up, a batch of rows at a time, in tiles of ``TILE`` columns by as many. A task
    holds the sums of one pair of tiles and reads the columns of these two, so that its memory does
    not grow with the number of columns; up to ``TILE`` columns are one tile and one scan. A task
    hands over one row for each pair of columns, whatever its number of rows.
    """
    if method not in ("listwise", "pairwise"):
        raise ValueError(f"method must be 'listwise' or 'pairwise', not {method!r}")
    if method == "listwise":
        df = df.where(all_present(df, columns))
    cells = _cells(_pair_sums(df, columns), columns)
    return cells if digits is None else cells.withColumn("corr", F.round("corr", digits))


def _standardised(df: DataFrame, columns: list[str]) -> list[Column]:
    """Values less the mean and in units of the deviation; a constant is all zero."""
    values = {c: _present(df, c) for c in columns}
    x = F.col("x")
    spread = [F.stddev_pop(x).alias("std"), (F.max(x) - F.min(x)).alias("range")]
    found = by_column(df, values, [F.avg(x).alias("mean"), *spread])
    stats = {r["column"]: r for r in found.collect()}  # one row for each column

    def scaled(name: str) -> Column:
        mean, std = stats[name]["mean"] or 0.0, stats[name]["std"]
        varies = bool(std) and stats[name]["range"] > 0
        return (values[name] - F.lit(mean)) / F.lit(std) if varies else values[name] * 0.0

    return [scaled(c) for c in columns]


PAIR_SUMS = ("n", "x", "y", "xx", "yy", "xy")
TILE = 512  # columns; the sums of a pair of tiles take 13 MB
VALUES = 1 << 21  # numbers that are multiplied at a time


def _pair_sums(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(a, b, n, x, y, xx, yy, xy)`` for every pair of column positions ``a < b``: sums over the
    rows in which both are present."""
    ship_package(df.sparkSession)
    scaled = _standardised(df, columns)
    tiles = [range(i, min(i + TILE, len(columns))) for i in range(0, len(columns), TILE)]
    partial = [
        _tile_sums(df, scaled, left, right)
        for i, left in enumerate(tiles)
        for right in tiles[i:]
    ]
    sums = reduce(DataFrame.union, partial)
    return sums.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in PAIR_SUMS])


def _tile_sums(df: DataFrame, scaled: list[Column], left: range, right: range) -> DataFrame:
    """The sums of one task's rows for the columns of two tiles, which may be the same."""
    same = left == right
    width = len(left) + (0 if same else len(right))
    if same:
        first, second = np.triu_indices(len(left), 1)
    else:
        first, second = (x.ravel() for x in np.indices((len(left), len(right))))
    a, b = first + left.start, second + right.start

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(PAIR_SUMS), len(left), len(right)))
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            rows = flat.astype(np.float64, copy=False).reshape(-1, width)
            step = max(1, VALUES // width)
            for at in range(0, len(rows), step):
                z = rows[at : at + step]
                there = (~np.isnan(z)).astype(np.float64)
                z = np.where(np.isnan(z), 0.0, z)
                x, x_there = z[:, : len(left)], there[:, : len(left)]
                y, y_there = z[:, width - len(right) :], there[:, width - len(right) :]
                total[0] += x_there.T @ y_there
                total[1] += x.T @ y_there
                total[2] += x_there.T @ y
                total[3] += (x * x).T @ y_there
                total[4] += x_there.T @ (y * y)
                total[5] += x.T @ y
        sums = [pa.array(total[i][first, second]) for i in range(len(PAIR_SUMS))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32()), *sums], ["a", "b", *PAIR_SUMS]
        )

    used = [scaled[i] for i in (left if same else [*left, *right])]
    schema = "a int, b int, " + ", ".join(f"{c} double" for c in PAIR_SUMS)
    return df.select(F.array(*used).alias("z")).mapInArrow(add_up, schema)


def _cells(sums: DataFrame, columns: list[str]) -> DataFrame:
    """All cells of the matrix out of the sums above its diagonal."""
    n = F.nullif(F.col("n"), F.lit(0.0))
    spread = {c: F.col(c + c) - F.col(c) * F.col(c) / n for c in ("x", "y")}
    # What is left by rounding of a column that is constant in the rows of the pair.
    noise = {c: 1e-13 * F.col(c + c) for c in ("x", "y")}
    varies = (F.col("n") > 1) & (spread["x"] > noise["x"]) & (spread["y"] > noise["y"])
    raw = (F.col("xy") - F.col("x") * F.col("y") / n) / F.sqrt(spread["x"] * spread["y"])
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw))
    found = sums.select("a", "b", F.when(varies, bounded).alias("corr"))

    # All cells come from a range; a pair is found from both of its sides.
    width = len(columns)
    every = sums.sparkSession.range(width * width).select(
        F.expr(f"cast(id div {width} as int)").alias("row"), F.expr(f"cast(id % {width} as int)").alias("col")
    )
    here = (F.least("row", "col") == F.col("a")) & (F.greatest("row", "col") == F.col("b"))
    name = F.array(*[F.lit(c) for c in columns])
    return every.join(found, here, "left").select(
        F.get(name, F.col("row")).alias("feature_a"),
        F.get(name, F.col("col")).alias("feature_b"),
        F.when(F.col("row") == F.col("col"), 1.0).otherwise(F.col("corr")).alias("corr"),
    )


def feature_label_corr(
    df: DataFrame, columns: list[str], label: Column, digits: int | None = 4
) -> DataFrame:
    """Correlation of each feature with a 0/1 label, strongest first.

    Pairwise complete: a row counts for a feature when both the feature and the label are present.
    """
    found = by_column(df, {c: _present(df, c) for c in columns}, [_pearson()], y=label)
    ranked = found.orderBy(F.abs("corr").desc_nulls_last(), "column")
    shown = F.col("corr") if digits is None else F.round("corr", digits)
    return ranked.select(
        F.col("column").alias("feature"), shown.alias("corr"), F.abs(shown).alias("abs_corr")
    )
