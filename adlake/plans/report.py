"""The company-wide daily revenue/cost report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.dates import date_keys
from adlake.functions.schema import conform
from adlake.operators.merge import merge
from adlake.operators.relational import union_all
from adlake.plans.contracts import CONTRACTS
from adlake.sources.writers import stage

REPORT = CONTRACTS["daily_report"]


def estimates(products: DataFrame, run_date: dt.date) -> DataFrame:
    """Report rows of the run date for products with an estimated daily revenue."""
    return products.filter(F.col("avg_estimated_daily_revenues").isNotNull()).select(
        *date_keys(F.lit(run_date)),
        F.col("id").alias("product_key"),
        F.col("avg_estimated_daily_revenues").alias("revenues"),
        F.col("avg_estimated_daily_direct_costs").alias("direct_costs"),
    )


def staged_report(rollups: Sequence[DataFrame], products: DataFrame, run_date: dt.date) -> DataFrame:
    """All rollups, plus an estimate for every product key no rollup produced.

    The rollups scan the large facts; they are computed once and staged, the
    merges then work on report rows.
    """
    rows = stage(union_all(*[conform(r, REPORT.table_schema()) for r in rollups]), "report")
    return merge(rows, estimates(products, run_date), CONTRACTS["report_estimates"].spec())


def daily_report(
    rollups: Sequence[DataFrame], products: DataFrame, existing: DataFrame, run_date: dt.date,
) -> DataFrame:
    """The report table after this run: staged rows merged into the existing ones."""
    return merge(existing, staged_report(rollups, products, run_date), REPORT.spec())
