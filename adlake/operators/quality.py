"""Declarative data checks. Each returns its failures; counts are taken distributed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any, Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values occurring more than once, with their counts; NULLs are ignored."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("occurrences")
    )
    return counts.filter(F.col("occurrences") > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is NULL."""
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Rows holding any other value; NULLs pass."""
    return df.filter(~F.col(column).isin(list(values)))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key values without a parent and how often each occurs; NULLs pass.

    Child keys are counted before they are joined, so a key that fills a third
    of the child table travels as one row per task.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("occurrences")
    )
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return keys.join(known, column, "left_anti")


@dataclass(frozen=True)
class Check:
    """One declared check. ``values`` and ``to`` (model, column) as the kind needs them."""

    model: str
    column: str
    kind: Literal["unique", "not_null", "accepted_values", "relationships"]
    values: Sequence[Any] = ()
    to: tuple[str, str] | None = None


def is_bad(check: Check) -> Column:
    """Whether a row fails a check that looks at one row."""
    column = F.col(check.column)
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(list(check.values))
    raise ValueError(f"{check.kind} needs more than one row")


def _failures(models: Mapping[str, DataFrame], check: Check) -> DataFrame:
    df = models[check.model]
    if check.kind == "unique":
        return unique(df, check.column).agg(F.count(F.lit(1)).alias("failures"))
    if check.kind == "relationships":
        parent, key = check.to
        missing = relationships(df, check.column, models[parent], key)
        return missing.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("failures"))
    raise ValueError(check.kind)


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row-wise checks of one model in a single pass, one row per check."""
    entries = []
    for check in checks:
        bad = is_bad(check)
        entries.append(
            F.struct(
                F.lit(check.column).alias("column_name"),
                F.lit(check.kind).alias("test"),
                F.count(F.when(bad, 1)).alias("failures"),
            )
        )
    return df.agg(F.array(*entries).alias("__all")).select(F.explode("__all").alias("__c")).select("__c.*")


def quality_report(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row (model, column_name, test, failures) per declared check.

    Checks that only look at a row share one scan per model.
    """
    parts = []
    for model, df in models.items():
        mine = [c for c in checks if c.model == model]
        by_row = [c for c in mine if c.kind in ("not_null", "accepted_values")]
        if by_row:
            parts.append(_row_checks(df, by_row).withColumn("model", F.lit(model)))
        for check in mine:
            if check not in by_row:
                parts.append(
                    _failures(models, check).select(
                        F.lit(check.column).alias("column_name"),
                        F.lit(check.kind).alias("test"),
                        "failures",
                        F.lit(model).alias("model"),
                    )
                )
    report = reduce(DataFrame.unionByName, parts)
    return report.select("model", "column_name", "test", F.col("failures").cast("long"))
