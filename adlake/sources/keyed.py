"""Tables whose files say which keys they may hold: Parquet Bloom filters and pushed key lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.operators.merge import absent_rows
from adlake.operators.relational import join_reduced

# So many keys are looked up by the scan itself. The scan's filter is a chain of
# comparisons as long as the list, walked by recursion, so the list cannot be much longer.
LOOKED_UP = 1000
PUSHED_KEYS = "spark.sql.parquet.pushdown.inFilterThreshold"


def write_keyed(
    df: DataFrame, path: str, key: str, partition_by: Sequence[str] = (), mode: str = "append",
    row_group_bytes: int = 32 << 20, filter_bytes: int = 1 << 20,
) -> None:
    """Parquet with a Bloom filter of ``key`` in every row group, sized by the distinct keys found there.

    A filter takes ``filter_bytes`` at most, which is enough for some 800,000 keys at 1 % false
    hits; smaller row groups make lookups read less, and files a little larger.
    """
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode(mode).partitionBy(*partition_by).option("parquet.block.size", row_group_bytes)
    writer = writer.option(f"parquet.bloom.filter.enabled#{key}", True).option("parquet.bloom.filter.adaptive.enabled", True)
    writer.option("parquet.bloom.filter.max.bytes", filter_bytes).parquet(path)


def rows_of_keys(target: DataFrame, batch: DataFrame, key: str, most: int = LOOKED_UP) -> DataFrame:
    """The target's rows whose ``key`` the batch has.

    Up to ``most`` different keys become a filter of the scan: only row groups whose Bloom filter
    does not rule all of them out are read. More keys meet nearly every row group anyway; then
    it is a semi join. NULL keys have no rows.
    """
    typed = batch.select(F.col(f"`{key}`").cast(target.schema[key].dataType).alias("__asked")).dropna().distinct()
    asked = [r[0] for r in typed.limit(most + 1).collect()]
    if len(asked) > most:
        return join_reduced(target, typed, {key: "__asked"}, "left_semi")
    spark = target.sparkSession
    # Lists beyond this length would reach the files as their least and greatest value only.
    if int(spark.conf.get(PUSHED_KEYS)) < most:
        spark.conf.set(PUSHED_KEYS, str(most))
    return target.filter(F.col(f"`{key}`").isin(asked)) if asked else target.filter(F.lit(False))


def insert_keyed(batch: DataFrame, path: str, key: str, partition_by: Sequence[str] = (), most: int = LOOKED_UP, **layout: int) -> None:
    """Append the rows of a batch whose key a table of ``write_keyed`` lacks, one for each key.

    A batch that is run again adds nothing; a NULL key is an error.
    """
    target = batch.sparkSession.read.schema(batch.schema).parquet(path)
    near = rows_of_keys(target, batch, key, most)
    write_keyed(absent_rows(near, batch, key), path, key, partition_by, **layout)
