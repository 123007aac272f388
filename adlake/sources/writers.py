"""File sinks and table management."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.schema import conform
from adlake.session import scratch_path


CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", delimiter: str = ",") -> None:
    """CSV with a header, no index. One folder of part files, each with the header.

    Parts are written side by side; a sorted frame gives parts in sort order. Times keep
    their microseconds.
    """
    writer = df.write.mode(mode).option("header", True).option("sep", delimiter).option("escape", '"')
    zoned, plain = f"{CSV_TIME}XXX", CSV_TIME
    writer.option("timestampFormat", zoned).option("timestampNTZFormat", plain).csv(path)


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON record per line; NULL fields are written out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Columnar table files; a hot partition value is split over several writers."""
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """Create the table, or add the columns an existing one lacks."""
    if not spark.catalog.tableExists(name):
        empty = spark.createDataFrame([], schema)
        _save(empty, name, "errorifexists", partition_by, path)
        return
    present = {f.name.lower() for f in spark.table(name).schema.fields}
    added = [
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name.lower() not in present
    ]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop the table if it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _save(df: DataFrame, name: str, mode: str, partition_by: Sequence[str], path: str | None) -> None:
    writer = df.write.mode(mode).format("parquet").partitionBy(*partition_by)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def replace_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None,
) -> None:
    """Truncate and load."""
    _save(df, name, "overwrite", partition_by, path)


def append_table(df: DataFrame, name: str, schema: T.StructType | None = None) -> None:
    """Append rows typed and ordered like the declared schema (default: the table's)."""
    spark = df.sparkSession
    declared = schema or spark.table(name).schema
    conform(df, declared).write.mode("append").format("parquet").saveAsTable(name)


def with_day(df: DataFrame, ts: str, name: str = "dt") -> DataFrame:
    """Add the day column a table is partitioned by."""
    return df.withColumn(name, F.to_date(F.col(ts)))


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Compute a frame once: write it below the shared scratch folder and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
