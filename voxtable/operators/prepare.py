"""From the feature table to training input."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxtable.functions.scalars import all_present, decode_label, encode_label, hash_bucket
from voxtable.schemas import CLASS_NAMES, REDUNDANT_COLUMNS


def clean_features(
    df: DataFrame,
    drop: tuple[str, ...] = REDUNDANT_COLUMNS,
    label: str = "grade",
    positive: str = CLASS_NAMES[1],
    unmatched: str = "null",
) -> DataFrame:
    """Drop the redundant columns and encode the label as 0/1 in place."""
    return df.drop(*drop).withColumn(label, encode_label(F.col(label), positive, unmatched))


def hash_split(
    df: DataFrame, key: str, train_percent: int = 80, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Tag rows with ``split`` (train / test) and ``fold`` by a digest of their key.

    Unlike a random split the result does not depend on partitioning or row order, and a lost
    executor recomputes the same rows. Split and fold use different parts of the digest. A NULL
    key has no digest and is an error.
    """
    no_key = F.raise_error(F.lit("row without a key")).cast("string")
    known = F.coalesce(F.col(key).cast("string"), no_key)
    in_train = hash_bucket(known, 100, seed) < train_percent
    return df.withColumn("split", F.when(in_train, "train").otherwise("test")).withColumn(
        "fold", hash_bucket(known, folds, seed, part=1)
    )


def class_distribution(
    split: DataFrame, label: str = "label", names: tuple[str, ...] = CLASS_NAMES
) -> DataFrame:
    """Rows per split and class (D24, B8); one grouped count instead of one per split (G1)."""
    return (
        split.groupBy("split", label)
        .agg(F.count("*").alias("count"))
        .select("split", decode_label(F.col(label), names).alias("grade"), "count")
    )


def assemble(
    df: DataFrame, features: list[str], label: Column, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``features`` vector and double ``label``; rows with a missing feature or label drop (H1)."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    labelled = df.withColumn("label", label.cast("double")).where(F.col("label").isNotNull())
    return assembler.transform(labelled).select(*carry, "features", "label")


def assemble_report(
    df: DataFrame, features: list[str], label: Column | None = None
) -> DataFrame:
    """How many rows ``assemble`` keeps and drops, and for what, one row (H1).

    A row without a label counts as one without a label, whether or not a feature is missing too.
    """
    featured = all_present(df, features)
    labelled = F.lit(True) if label is None else label.isNotNull()
    return df.agg(
        F.count_if(featured & labelled).alias("kept"),
        F.count_if(~(featured & labelled)).alias("dropped"),
        F.count_if(~labelled).alias("without_label"),
        F.count_if(labelled & ~featured).alias("without_feature"),
        F.count("*").alias("total"),
    )
