"""Exact order statistics without a global sort in one task.

A single-partition window and ``median()`` (one value map per group) both put all distinct values
into one task. Here the value range is cut at quantiles of the data first, so that one task sorts
a known share of the rows at most. The quantile sketch steers that share; it cannot change a
result.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxtable.functions.scalars import is_missing


def exact_median(df: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """Median of the present values, mean of the two middle ones; one row ``median``.

    A quantile sketch, which is off by at most 1 / ``accuracy`` of the rows, gives two cuts closely
    around the middle; the rows below, between and above are counted; the range that holds the
    middle ranks, some five rows in ``accuracy``, is counted by value, cut at its own quantiles,
    and ranked in as many tasks as there are shuffle partitions. Runs one job to cut the range.
    """
    values = df.where(~is_missing(df, column)).select(F.col(column).cast("double").alias("value"))
    near = [max(0.0, 0.5 - 1.5 / accuracy), min(1.0, 0.5 + 1.5 / accuracy)]
    cuts = values.agg(F.percentile_approx("value", near, accuracy)).scalar()
    above = [(F.col("value") >= cuts[0]).cast("int"), (F.col("value") > cuts[1]).cast("int")]
    ranges = values.withColumn("range", above[0] + above[1])

    upwards = Window.orderBy("range")  # three rows
    totals = ranges.groupBy("range").agg(F.count("*").alias("total"))
    offsets = totals.select(
        "range",
        F.sum("total").over(upwards).alias("end"),
        (F.sum("total").over(upwards) - F.col("total")).alias("before"),
        F.sum("total").over(Window.partitionBy()).alias("size"),
    )
    low, high = F.expr("(size - 1) div 2"), F.expr("size div 2")
    middle = (
        offsets.where((F.col("before") <= high) & (F.col("end") > low))
        .agg(
            F.struct(
                F.min("range").alias("first"),
                F.max("range").alias("last"),
                F.min("before").alias("before"),
                F.min("size").alias("size"),
            )
        )
        .scalar()
    )

    counts = (
        ranges.where(F.col("range").between(middle["first"], middle["last"]))
        .groupBy("value")
        .agg(F.count("*").alias("n"))
    )
    # The middle range is dealt to as many tasks as there are shuffle partitions; each ranks its
    # own values, and the totals of the buckets, one row each, are summed up before.
    bucketed = with_bucket(counts, "value", range_splits(counts, "value"))
    totals = bucketed.groupBy("bucket").agg(F.sum("n").alias("total"))
    running = F.sum("total").over(Window.orderBy("bucket"))
    starts = totals.select("bucket", (running - F.col("total")).alias("start"))
    inside = F.sum("n").over(Window.partitionBy("bucket").orderBy("value"))
    ranked = bucketed.withColumn("inside", inside).join(starts, "bucket")
    end = middle["before"] + F.col("start") + F.col("inside")
    ranked = ranked.select("value", "n", end.alias("end"), middle["size"].alias("size"))

    def at(rank):
        here = (F.col("end") - F.col("n") <= rank) & (F.col("end") > rank)
        return F.max(F.when(here, F.col("value")))

    return ranked.agg(at(low).alias("low"), at(high).alias("high")).select(
        ((F.col("low") + F.col("high")) / 2).alias("median")
    )


def range_splits(df: DataFrame, column: str, buckets: int | None = None) -> list[float]:
    """Ascending cut points that share the rows of a double column out evenly.

    As many buckets as there are shuffle partitions, so that a bucket is what a task is sized for
    anyway. Runs one job.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(column, shares, 4 * buckets)).head()[0] or []
    return sorted({c for c in cuts if abs(c) != float("inf")})


def with_bucket(df: DataFrame, column: str, splits: list[float]) -> DataFrame:
    """Add ``bucket``: a function of the value alone that never decreases with it."""
    if not splits:
        return df.withColumn("bucket", F.lit(0))
    edges = [-float("inf"), *splits, float("inf")]
    bucketizer = Bucketizer(splits=edges, inputCol=column, outputCol="bucket")
    return bucketizer.transform(df).withColumn("bucket", F.col("bucket").cast("int"))


def with_group_bucket(df: DataFrame, column: str, by: tuple[str, ...], buckets: int) -> DataFrame:
    """Add ``bucket``: within a group a function of the value that never decreases with it.

    Every group is cut at quantiles of its own, so its values are shared out evenly wherever they
    lie. A group's cuts are one row; they are joined to the rows, and no group is gathered.
    """
    if buckets < 2:
        return df.withColumn("bucket", F.lit(0))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = F.array_distinct(F.percentile_approx(column, shares, 4 * buckets)).alias("cuts")
    below = F.size(F.filter("cuts", lambda cut: cut <= F.col(column))).alias("bucket")
    if not by:
        return df.withColumn("cuts", df.agg(cuts).scalar()).select(*df.columns, below)
    keys = [f"group {i}" for i in range(len(by))]
    groups = df.groupBy(*[F.col(c).alias(k) for c, k in zip(by, keys)]).agg(cuts)
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`{k}`")) for c, k in zip(by, keys)]
    return df.join(groups, same).select(*df.columns, below)


def area_under_roc(
    scored: DataFrame, score: str = "score", label: str = "label", by: tuple[str, ...] = ()
) -> DataFrame:
    """Exact, tie-aware area under the ROC curve per ``by`` group.

    The share of (positive, negative) pairs that the score puts in order, ties counting one half.
    Rows are counted per score first: a score shared by a third of the rows is one row. The
    running count of negatives is a window inside each bucket plus the total of the buckets below.
    Buckets are cut for each group, by as many scores each, so that a model whose scores lie close
    together is spread as well as any other.
    NULL if one class is absent. A missing score and a label other than 0 and 1 are errors, so
    that the area and the confusion matrix describe the same rows.
    """
    no_score = F.raise_error(F.lit("missing score")).cast("double")
    no_label = F.raise_error(F.lit("label other than 0 and 1")).cast("double")
    given, labelled = F.col(score).cast("double"), F.col(label).cast("double")
    rows = scored.select(
        *by,
        F.when(is_missing(scored, score), no_score).otherwise(given).alias("score"),
        F.when(labelled.isin(0.0, 1.0), labelled).otherwise(no_label).alias("label"),
    )
    ties = rows.groupBy(*by, "score").agg(
        F.count_if(F.col("label") == 1).cast("double").alias("pos"),
        F.count_if(F.col("label") == 0).cast("double").alias("neg"),
    )
    buckets = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ties = with_group_bucket(ties, "score", by, buckets)

    inside = Window.partitionBy(*by, "bucket").orderBy("score")
    before = F.sum("neg").over(inside) - F.col("neg")
    folded = (
        ties.withColumn("neg_before", before)
        .groupBy(*by, "bucket")
        .agg(
            F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)).alias("inner_pairs"),
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
        )
    )
    by_bucket = Window.partitionBy(*by).orderBy("bucket")  # at most one row per bucket and group
    below = F.sum("neg").over(by_bucket) - F.col("neg")
    return (
        folded.withColumn("pairs", F.col("inner_pairs") + F.col("pos") * below)
        .groupBy(*by)
        .agg(F.try_divide(F.sum("pairs"), F.sum("pos") * F.sum("neg")).alias("auc"))
    )
