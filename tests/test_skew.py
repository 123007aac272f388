"""Hot keys: adaptive execution splits them, and results stay whole."""

import pytest
from pyspark.sql import functions as F

from adlake.operators import relational as R
from adlake.operators.merge import MergeSpec, merge

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
N = 300_000


@pytest.fixture
def tiny_partitions(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield spark
    for key in SMALL:
        spark.conf.unset(key)


def hot(spark, key=-1):
    """A third of the rows share one key."""
    k = F.when(F.col("id") % 3 == 0, F.lit(key)).otherwise(F.col("id") % 1000)
    return spark.range(0, N, 1, 8).select(k.cast("long").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


def small(spark):
    return spark.range(-1, 1000).select(F.col("id").alias("key"), F.lit("x").alias("w"))


def final_plan(df):
    """Run the frame and return the plan adaptive execution ended with."""
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_left_join_with_an_aggregated_side_is_split(tiny_partitions):
    spark = tiny_partitions
    right = small(spark).repartition(4).groupBy("key").agg(F.max("w").alias("w"))
    rows, plan = final_plan(R.join_reduced(hot(spark), right, {"k": "key"}, "left").select("k", "w"))
    assert len(rows) == N and all(r["w"] == "x" for r in rows)
    assert "skew=true" in plan or "isSkewJoin" in plan or "skewed" in plan


def test_plain_join_with_an_aggregated_side_is_not_split(tiny_partitions):
    """What join_reduced is for: without its own exchange the hot partition stays whole."""
    spark = tiny_partitions
    right = small(spark).repartition(4).groupBy("key").agg(F.max("w").alias("w"))
    _, plan = final_plan(hot(spark).join(right, F.col("k") == F.col("key"), "left").select("k", "w"))
    assert "skew" not in plan


def test_null_keys_are_spread(tiny_partitions):
    spark = tiny_partitions
    df = R.join_reduced(hot(spark, key=None), small(spark), {"k": "key"}, "left")
    counts = [r["n"] for r in df.filter("k IS NULL").groupBy(F.spark_partition_id()).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert sum(counts) == N // 3 and max(counts) < N // 6


def test_semi_and_anti_joins_are_split(tiny_partitions):
    spark = tiny_partitions
    keys = small(spark).filter("key <> 5").select(F.col("key").alias("k"))
    rows, plan = final_plan(R.members(hot(spark), keys, "k").select("k"))
    assert len(rows) == N - sum(1 for i in range(N) if i % 3 and i % 1000 == 5) and "skew" in plan
    rows, plan = final_plan(R.without(hot(spark), keys, "k", "k").select("k"))
    assert {r["k"] for r in rows} == {5} and "skew" in plan


def test_merge_splits_a_hot_target_key_and_keeps_all_rows(tiny_partitions):
    spark = tiny_partitions
    target = hot(spark)
    source = small(spark).select(F.col("key").alias("k"), F.lit("new").alias("v"))
    merged = merge(target, source, MergeSpec(on=["k"], update={"v": "v"}))
    rows, plan = final_plan(merged)
    absent = sum(1 for k in range(0, 1000) if not any((i % 3) and i % 1000 == k for i in range(k, N, 1000)))
    assert len(rows) == N + absent and "skew" in plan
    assert sum(r["k"] == -1 for r in rows) == N // 3 and all(r["v"] == "new" for r in rows)


def test_merge_takes_in_a_hot_new_key(tiny_partitions):
    spark = tiny_partitions
    target = small(spark).filter("key >= 0").select(F.col("key").alias("k"), F.lit("old").alias("v"))
    rows, plan = final_plan(merge(target, hot(spark), MergeSpec(on=["k"])))
    assert sum(r["k"] == -1 for r in rows) == N // 3 and "skew" in plan
