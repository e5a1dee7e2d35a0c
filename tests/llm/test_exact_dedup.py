import pytest
from pyspark.sql import functions as F

from voxtable.llm import exact_dedup


@pytest.mark.parametrize("bits_per_row", [1, 4, 16])
@pytest.mark.parametrize("max_bytes", [0, 1 << 20])
def test_no_size_of_the_filter_changes_a_result(spark, max_bytes, bits_per_row):
    texts = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("T"), F.col("id") % 3000).alias("text")
    )
    marked = exact_dedup.mark_duplicates(texts, max_filter_bytes=max_bytes, bits_per_row=bits_per_row)
    sizes = marked.groupBy("group_size", "kept").count().collect()
    assert {(r.group_size, r.kept): r["count"] for r in sizes} == {
        (1, True): 2000,
        (2, True): 1000,
        (2, False): 1000,
    }
    assert marked.where("kept AND keep_id <> doc_id").count() == 0


def test_the_filter_rejects_what_occurs_once(spark):
    hashes = spark.range(2000).select(F.xxhash64("id").alias("hash"))
    bits = exact_dedup.filter_bits(2000, 16)
    assert bits == 32_768
    found = exact_dedup.repeat_filter(hashes.union(hashes.limit(100)), bits)
    assert found.count() == 1
    assert found.first().bitmap is not None
    assert exact_dedup.filter_bits(10**9, 16) == 1 << 34
    assert exact_dedup.filter_bits(0, 16) == 32_768


def test_the_filter_is_broadcast_up_to_its_bound(spark):
    texts = spark.range(4000).selectExpr("id as doc_id", "cast(id % 3900 as string) as text")

    def joins(max_bytes):
        plan = exact_dedup.mark_duplicates(texts, max_filter_bytes=max_bytes)._jdf.queryExecution()
        return [line for line in plan.executedPlan().toString().split("\n") if "Join [block" in line]

    assert all("BroadcastHashJoin" in line for line in joins(1 << 20))
    assert all("SortMergeJoin" in line for line in joins(0)) and joins(0)


def test_a_hot_text(spark):
    texts = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "Same").otherwise(F.concat(F.lit("t"), "id")).alias("text"),
    )
    marked = exact_dedup.mark_duplicates(texts)
    hot = marked.where("group_size > 1")
    assert hot.count() == 2000
    assert [r.doc_id for r in hot.where("kept").collect()] == [5997]
    assert exact_dedup.drop_duplicates(texts).count() == 4001
