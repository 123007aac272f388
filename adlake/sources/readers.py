"""Landed files, external queries and report sets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import or_
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.dates import date_range
from adlake.operators.relational import join_reduced, without


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
    header: bool = True, multiline: bool = False,
) -> DataFrame:
    """CSV with inferred types (no ``schema``) or a declared, positional schema.

    Inference costs a pass of its own; declare the schema of large inputs.
    ``multiline`` admits line breaks inside quotes, at the price that a file is
    no longer split: land such data as many files.
    """
    reader = spark.read.option("header", header).option("escape", '"')
    if multiline:
        reader = reader.option("multiLine", True)
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema).option("enforceSchema", True).option("mode", "FAILFAST")
    return reader.csv(path)


def read_ndjson(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
) -> DataFrame:
    """One JSON record per line."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_query(
    spark: SparkSession, table: str | None = None, options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A catalog table, or a query of an external database over JDBC.

    For a large result pass ``dbtable`` with ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions``, so that executors read it side by side.
    """
    if table is not None:
        return spark.table(table)
    return spark.read.format("jdbc").options(**(options or {})).load()


def plain_path(path: Column) -> Column:
    """A file's path as one writes it: decoded, local ones without their scheme."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def read_reports(
    spark: SparkSession, manifest: DataFrame, paths: list[str] | str, schema: T.StructType,
    rule: Literal["fields", "cells", "fail"] = "fields",
) -> tuple[DataFrame, DataFrame]:
    """Report files with the lineage columns of their manifest row, and the reports left out.

    ``manifest`` has one row per file: ``file_path`` (the whole path) and the
    lineage columns. A file without a row, or with several, is an error. A report is
    left out as a whole if it has a row the ``rule`` calls bad:

    * ``fields``: more fields than declared, whatever they hold. Short rows are filled with NULL,
      and so are cells that cannot be converted;
    * ``cells``: also a cell that cannot be converted;
    * ``fail``: none is left out; such a row or cell fails the read.

    The second frame has ``file_path``, ``reason`` and ``bad_rows`` of each report left out.
    """
    # A row with more or fewer fields than declared comes with its text, from which they are
    # counted: an empty cell and a missing one look alike among the columns.
    record = "__record"
    texts = T.StructType([T.StructField(n, T.StringType()) for n in (*schema.names, record)])
    read = (
        spark.read.schema(texts).option("header", True).option("escape", '"').option("columnPruning", False)
        .option("columnNameOfCorruptRecord", record).csv(paths)
        .withColumn("__file", plain_path(F.col("_metadata.file_path")))
    )
    unquoted = F.regexp_replace(record, '"(?:[^"]|"")*"', "")
    fields = F.length(F.regexp_replace(unquoted, "[^,]", "")) + 1
    # A text that is its own first cell has one field; Spark wants another column read with the text.
    one = F.col(f"`{schema.names[0]}`").eqNullSafe(F.col(record))
    too_long = F.coalesce(fields > len(schema.names), F.lit(False)) & ~one
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    broken = reduce(or_, [F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()
                          for f in schema.fields], F.lit(False))
    rows = read.select("__file", *typed, too_long.alias("__long"), broken.alias("__broken"))
    verdict = rows.groupBy(F.col("__file").alias("file_path")).agg(
        F.count_if("__long").alias("long"), F.count_if("__broken").alias("broken")
    )
    cells = (F.col("broken") > 0) & F.lit(rule == "cells")
    reason = F.when(F.col("long") > 0, "a row has too many fields").when(cells, "a cell cannot be converted")
    bad = F.when(F.col("long") > 0, F.col("long")).otherwise(F.col("broken"))
    rejected = verdict.select("file_path", reason.alias("reason"), bad.alias("bad_rows")).filter("reason IS NOT NULL")
    if rule == "fail":
        rejected = rejected.limit(0)
        bad = F.raise_error(F.concat(F.lit("unreadable row in "), F.col("__file"))).cast("boolean")
        rows = rows.filter(F.when(F.col("__long") | F.col("__broken"), bad).otherwise(True))
    kept = without(rows, rejected, "__file", "file_path")
    lineage = [c for c in manifest.columns if c != "file_path"]
    entries = manifest.groupBy(F.regexp_replace("file_path", "^file:/+", "/").alias("__path")).agg(
        F.count(F.lit(1)).alias("__entries"), F.first(F.struct(*lineage)).alias("__lineage")
    )
    joined = join_reduced(kept, entries, {"__file": "__path"}, "left")
    wrong = F.raise_error(F.concat(F.lit("not exactly one manifest row for "), F.col("__file"))).cast("boolean")
    checked = joined.filter(F.when(F.col("__entries") == 1, True).otherwise(wrong))
    return checked.select(F.col("__file").alias("file_path"), *schema.names, *[f"__lineage.{c}" for c in lineage]), rejected


def partition_window(
    df: DataFrame, column: str, start: dt.date, end: dt.date, inclusive: bool = True,
) -> DataFrame:
    """Restrict to a date window with a predicate the scan can prune by."""
    return df.filter(date_range(F.col(column), start, end, inclusive))
