"""What the operators share: session limits, ranks without a hot task, text hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.operators.relational import join_reduced
from adlake.session import apply_defaults
from adlake.sources.writers import stage

# Rows of one Arrow batch. Texts may be long, and a batch is held whole by a Python worker.
BATCH_ROWS = 256
# Rows that one task numbers at a time.
PART_ROWS = 1 << 14


def prepared(spark: SparkSession) -> SparkSession:
    apply_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def dealt(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], spread: str | None = None, part_rows: int = PART_ROWS,
) -> DataFrame:
    """Add ``__salt`` and ``__piece``, which deal each key into parts of some ``part_rows`` rows.

    The salt is a hash of ``order``, taken modulo what the key's rows need. Rows that are equal
    in ``order`` share it; where there are more than ``part_rows`` of them, the column ``spread``
    deals them into pieces of their own (from 1; all other rows are in piece 0). Both joins are
    with one row per key, or per value that fills a part, and are broadcast only if Spark finds
    what was staged small enough.
    """
    hashed = df.withColumn("__hash", F.xxhash64(*order))
    names = {k: f"__of_{k}" for k in keys}
    own = [F.col(k).alias(n) for k, n in names.items()]
    needed = lambda: F.ceil(F.count(F.lit(1)) / F.lit(part_rows))
    parts = stage(hashed.groupBy(*own).agg(needed().alias("__parts")), "rank-keys")
    salted = join_reduced(hashed, parts, names, "inner", null_safe=True).drop(*names.values()).withColumn(
        "__salt", F.pmod("__hash", "__parts")
    )
    if not spread:
        return salted.withColumn("__piece", F.lit(0).cast("long")).drop("__hash", "__parts")
    names["__hash"] = "__of_hash"
    equal = hashed.groupBy(*own, F.col("__hash").alias("__of_hash")).agg(needed().alias("__pieces"))
    equal = stage(equal.filter("__pieces > 1"), "rank-equal")
    piece = F.pmod(F.xxhash64(spread), F.col("__pieces")) + 1
    return join_reduced(salted, equal, names, "left", null_safe=True).withColumn(
        "__piece", F.coalesce(piece, F.lit(0)).cast("long")
    ).drop("__hash", "__parts", "__pieces", *names.values())


def ranked(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, spread: str | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Add a gapless rank from 0 within ``keys``, whose columns must not be NULL.

    A key may hold a third of all rows, so a window over the key alone would put them into one
    task. Rows are numbered within the parts of ``dealt``, whose number grows with the key, and
    what the earlier parts of the key hold is added. Rows equal in ``order`` get different ranks
    in any order; if they may fill a part, name a stored column of random numbers as ``spread``.
    ``df`` is read several times and must give the same rows each time, as staged frames do.
    """
    parts = dealt(df, keys, order, spread, part_rows)
    counts = parts.groupBy(*keys, "__salt", "__piece").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__salt", "__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, "__salt", "__piece", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )
    part = Window.partitionBy(*keys, "__salt", "__piece").orderBy(*order)
    numbered = parts.withColumn("__local", F.row_number().over(part) - 1)
    return (
        numbered.join(offsets, [*keys, "__salt", "__piece"])
        .withColumn(name, F.col("__local") + F.col("__before"))
        .drop("__salt", "__piece", "__local", "__before")
    )


def random_number() -> Column:
    """What rows may be spread by, once it is stored."""
    return (F.rand() * (1 << 31)).cast("int")


def text_hash(column: str = "text") -> Column:
    """64 bits that stand for a text; NULL counts as empty."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))
