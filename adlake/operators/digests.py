"""Order-independent digests of partitions, so that a reload leaves alone what it does not change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.merge import touched_partitions
from adlake.operators.relational import join_reduced
from adlake.sources.writers import stage

SECOND_SEED = 1


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row that also tell NULLs apart from neighbours' values.

    Spark does not hash maps: they go by their entries in order, and maps inside other types by their JSON.
    """
    parts = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType.simpleString()
        if kind.startswith("map<"):
            column = F.to_json(F.array_sort(F.map_entries(column)))
        elif "map<" in kind:
            column = F.to_json(F.struct(column))
        parts += [column.isNull(), column]
    return F.xxhash64(*parts), F.xxhash64(F.lit(SECOND_SEED), *parts)


def partition_digests(df: DataFrame, partition: str) -> DataFrame:
    """For each value of ``partition``: ``rows``, and a sum and an exclusive or of row hashes.

    Neither depends on the order of rows or on how files hold them. Combined before the shuffle, so
    a partition of any size travels as one row for each task.
    """
    first, second = row_hashes(df)
    return df.groupBy(F.col(f"`{partition}`").alias("__part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(first.cast("decimal(38,0)")).alias("added"), F.bit_xor(second).alias("mixed")
    )


def changed_partitions(before: DataFrame, after: DataFrame, partition: str) -> DataFrame:
    """``__part`` values of ``after`` whose rows are not those of ``before``."""
    old = partition_digests(before, partition).select(F.col("__part").alias("__old"), "rows", "added", "mixed")
    renamed = old.toDF("__old", "__rows", "__added", "__mixed")
    both = join_reduced(partition_digests(after, partition), renamed, {"__part": "__old"}, "left", null_safe=True)
    same = F.col("rows").eqNullSafe(F.col("__rows")) & F.col("added").eqNullSafe(F.col("__added")) & F.col("mixed").eqNullSafe(F.col("__mixed"))
    return both.filter(~same).select("__part")


def reload_partitions(spark: SparkSession, path: str, rows: DataFrame, partition: str) -> int:
    """Make the partitions that ``rows`` has equal to them, and rewrite only those that differ; gives how many.

    For restatements: a reload of a month of which a few days changed. The table's other
    partitions, and the files of equal ones, are not touched. Two different partitions pass for equal
    with a chance of about 2^-100. Rows are computed once and staged; ``path`` must hold a
    Parquet table of their columns.
    """
    rows = stage(rows, "reload")
    target = spark.read.schema(rows.schema).parquet(path)
    changed = changed_partitions(touched_partitions(target, rows, partition, partition).select(rows.columns), rows, partition)
    changed = stage(changed, "changed")
    count = changed.count()
    if count:
        different = join_reduced(rows, changed, {partition: "__part"}, "left_semi", null_safe=True)
        writer = different.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(partition).parquet(path)
    return count
