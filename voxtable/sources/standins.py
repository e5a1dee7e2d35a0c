"""Views that let the given tables stand in for the library's inputs; see FIXTURES.md."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRAINING_FEATURES = ["n_chars", "n_words", "n_lines", "n_unique_lines", "n_digits"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slice_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as slices, discount / tax / returned quantity as channel counts."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("volume_id"),
        F.col("l_linenumber").alias("slice"),
        F.floor(F.col("l_discount") * 100 + 0.5).alias("n0"),
        F.floor(F.col("l_tax") * 100 + 0.5).alias("n1"),
        returned.cast("bigint").alias("n2"),
    )


def tensor_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 4 x 4 slices with 4 modalities; the raw mask grades values of the first
    three of them as 1 above 0.25, 2 above 0.3 and 4 above 0.4."""
    first_three = F.filter("embedding", lambda _, i: i % 4 < 3)
    graded = F.transform(
        first_three,
        lambda v: F.when(v > 0.4, 4).when(v > 0.3, 2).when(v > 0.25, 1).otherwise(0).cast("tinyint"),
    )
    return table(spark, sf_dir, "embeddings").select(
        F.expr("vec_id div 2").alias("volume_id"),
        F.col("vec_id").alias("slice_idx"),
        F.lit(4).alias("h"),
        F.lit(4).alias("w"),
        F.col("embedding").alias("image"),
        graded.alias("mask"),
    )


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of all orders."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("volume_id"))


def nation_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: subjects ``NATION_<k>`` with their region as label; one region is unmapped."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        nation.where(F.col("n_regionkey") < 4)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_name").alias("subject_id"), F.col("r_name").alias("grade"))
    )


def nation_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers keyed by the number of their nation, to be labelled through T4."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("bigint").alias("volume_id")
    )


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as subjects; the name ends in the volume id, the segment is the label."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("subject_id"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"), "HGG")
        .otherwise("LGG")
        .alias("grade"),
    )


def survival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: an attribute known for one market segment only."""
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") == "BUILDING")
        .select(F.col("c_name").alias("subject_id"), F.col("c_acctbal").alias("age"))
    )


def scored(
    spark: SparkSession, sf_dir: str, thresholds: dict[str, float] | None = None
) -> DataFrame:
    """Events as scored rows; each threshold on the value acts as one model."""
    thresholds = thresholds or {"value > 100": 100.0}
    models = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                (F.col("value") > cut).cast("double").alias("prediction"),
            )
            for name, cut in thresholds.items()
        ]
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        (F.col("event_type") == "purchase").cast("double").alias("label"),
        F.col("value").alias("score"),
        F.inline(models),
    )


def scored_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events scored by models whose scores lie in very different ranges."""
    value = F.col("value")
    scores = {"wide": value, "narrow": value / 1048576 + 0.5, "turned": -value * 1024}
    models = F.array(
        *[F.struct(F.lit(m).alias("model"), s.alias("score")) for m, s in scores.items()]
    )
    return table(spark, sf_dir, "events").select(
        (F.col("event_type") == "purchase").cast("double").alias("label"), F.inline(models)
    )


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with counts over their whole text as features.

    Texts without a label are left out before their words are counted, and the counts are taken
    below the join, which then moves six numbers per document, not texts.
    """
    text = F.col("text")
    lines = F.split(text, "\n")
    known = table(spark, sf_dir, "labels").select("doc_id")
    labelled = table(spark, sf_dir, "documents").join(known, "doc_id", "left_semi")
    counts = labelled.select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.regexp_count(text, F.lit(r"\S+")).cast("double").alias("n_words"),
        F.size(lines).cast("double").alias("n_lines"),
        F.size(F.array_distinct(lines)).cast("double").alias("n_unique_lines"),
        F.regexp_count(text, F.lit("[0-9]")).cast("double").alias("n_digits"),
    )
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    return counts.join(labels, "doc_id")


def exact_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with a label that is one of the 0/1 features, so that results are known."""
    is_english = (F.col("lang") == "en").cast("double")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        is_english.alias("is_english"),
        F.regexp_extract("source", r"(\d+)$", 1).cast("double").alias("source_number"),
        is_english.alias("label"),
    )


EXACT_FEATURES = ["n_chars", "is_english", "source_number"]


def ragged_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of two shapes: every third one is 2 x 4, the others are 4 x 4."""
    small = F.col("slice_idx") % 3 == 0
    pixels = F.when(small, 8).otherwise(16)
    return tensor_slices(spark, sf_dir).select(
        "volume_id",
        "slice_idx",
        F.when(small, 2).otherwise(4).alias("h"),
        "w",
        F.slice("image", F.lit(1), pixels * 4).alias("image"),
        F.slice("mask", F.lit(1), pixels * 3).alias("mask"),
    )


def eda_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines, with numeric columns and a group column."""
    return table(spark, sf_dir, "lineitem")


def eda_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels where known, for missing values."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
