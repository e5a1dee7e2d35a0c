"""Joins that complete the volume table, and the coverage of what they attached.

Joins carry no broadcast hint: Catalyst and AQE broadcast the small side only while its size is
below ``spark.sql.autoBroadcastJoinThreshold`` and fall back to a sort-merge join with skew
splitting beyond it. NULL keys match nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxtable.functions.scalars import is_missing, trailing_id
from voxtable.operators.ordered import exact_median


def merge_features(metadata: DataFrame, tensor_features: DataFrame) -> DataFrame:
    """Volumes present on both sides (C2). The metadata columns win over equally named ones.

    Both inputs come out of an aggregate on ``volume_id``, so the join needs no further shuffle.
    """
    extra = [c for c in tensor_features.columns if c not in metadata.columns]
    return metadata.join(tensor_features.select("volume_id", *extra), "volume_id", "inner")


def attach_label(
    df: DataFrame,
    name_map: DataFrame,
    subject_column: str = "subject_id",
    label_column: str = "grade",
    id_pattern: str = r"_(\d+)$",
    strict: bool = True,
) -> DataFrame:
    """Left join of subject and label on the number that ends the subject's name."""
    mapping = name_map.select(
        trailing_id(F.col(subject_column), id_pattern, strict).alias("volume_id"),
        F.col(subject_column).alias("subject_id"),
        F.col(label_column).alias("grade"),
    )
    return df.join(mapping, "volume_id", "left")


def attach_attribute(
    df: DataFrame, attributes: DataFrame, key: str = "subject_id", column: str = "age"
) -> DataFrame:
    """Left join of a partly missing attribute (C4)."""
    return df.join(attributes.select(key, column), key, "left")


def impute_median(
    df: DataFrame, column: str, approx: bool = False, fit_on: DataFrame | None = None
) -> DataFrame:
    """Fill missing values with the median of the present ones.

    The median is taken over all rows, or over ``fit_on`` (the training rows, say). It reaches the
    rows as a scalar subquery, for which its table is read again: pass a materialized frame if it
    is expensive to compute.
    """
    source = df if fit_on is None else fit_on
    if approx:
        present = source.where(~is_missing(source, column))
        median = present.agg(F.percentile_approx(F.col(column).cast("double"), 0.5, 10_000))
    else:
        median = exact_median(source, column)
    filled = F.when(is_missing(df, column), median.scalar()).otherwise(F.col(column).cast("double"))
    return df.withColumn(column, filled)


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Present, missing and total rows of one column, one row."""
    missing = is_missing(df, column)
    return df.agg(
        F.count_if(~missing).alias("present"),
        F.count_if(missing).alias("missing"),
        F.count("*").alias("total"),
    )


def label_frequencies(df: DataFrame, label: str = "grade") -> DataFrame:
    """Row count per label, without the missing ones."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
