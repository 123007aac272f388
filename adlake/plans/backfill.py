"""Invoice allocation and the daily report for a range of run dates in one pass.

Each gives the rows that the plans for one date give for every date of the range. Old invoices
weigh on all days of a month alike, so they are summed by month, into which each is put by a
generator (as many rows as months of the range its service touches), and the few sums are
spread over the calendar. The invoices are read once and shuffled as one row for each task and month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.dates import date_keys, date_range, month_start, with_days
from adlake.functions.scalars import rate, rounded, to_money
from adlake.functions.schema import conform
from adlake.operators.merge import merge
from adlake.operators.relational import join_reduced, union_all
from adlake.plans.contracts import CONTRACTS
from adlake.plans.invoices import AGENCY_KEY, COST_RATIO, MARKETPLACE_KEY, months_if_running_on, service_months
from adlake.plans.report import REPORT
from adlake.sources.writers import stage


def _old_months(issued: Column, begin: Column, finish: Column, start: dt.date, end: dt.date) -> Column:
    """The months of the range, by their first days, in which an invoice may be old money."""
    after_issue = F.add_months(F.trunc(issued, "month"), 1)
    first = F.greatest(after_issue, F.trunc(begin, "month"), F.lit(month_start(start)))
    last = F.least(F.trunc(finish, "month"), F.lit(month_start(end)))
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.when(first <= last, months).otherwise(F.array().cast("array<date>"))


def _overlapping(issued: Column, begin: Column, finish: Column, month: Column) -> Column:
    """The tests for one run date, by its month: midnight of the month's last day is the bound."""
    return (issued < month) & (begin <= F.last_day(month)) & (finish >= month)


def _days_in(month: Column) -> Column:
    return F.dayofmonth(F.last_day(month))


def _share(amount: Column) -> Column:
    return F.sum((amount / F.col("allocation").cast("decimal(10,0)")).cast("decimal(24,8)"))


def _sums(rows: DataFrame, by: str, cost_ratio: Decimal) -> DataFrame:
    revenue = F.col("revenue").cast("decimal(18,4)")
    return rows.groupBy(by).agg(_share(revenue).alias("revenues"), _share(revenue * rate(cost_ratio)).alias("direct_costs"))


def _by_day(new: DataFrame, old: DataFrame, start: dt.date, end: dt.date, product_key: str, cost_ratio: Decimal) -> DataFrame:
    """Report rows from shares of new money by ``day`` and of old money by ``month``; a day without either has none."""
    days = with_days(new.sparkSession.range(1), start, end, "day").select("day", F.trunc("day", "month").alias("month"))
    spread = days.join(_sums(old, "month", cost_ratio), "month").drop("month")
    both = _sums(new, "day", cost_ratio).unionByName(spread).groupBy("day")
    summed = both.agg(*[rounded(F.sum(c)).alias(c) for c in ("revenues", "direct_costs")])
    keys = date_keys(F.col("__day"))
    return summed.withColumnRenamed("day", "__day").select(*keys, F.lit(product_key).alias("product_key"), "revenues", "direct_costs")


def marketplace_range(
    invoices: DataFrame, start: dt.date, end: dt.date, cost_ratio: Decimal = COST_RATIO, product_key: str = MARKETPLACE_KEY,
) -> DataFrame:
    """``allocate_marketplace`` of every day from ``start`` to ``end``."""
    created, begin, finish, canceled = (F.col(c) for c in ("created_at", "period_start", "period_end", "canceled_at"))

    def kept(month: Column) -> Column:
        return canceled.isNull() | (canceled > F.last_day(month))

    live = invoices.filter(F.col("fastbill_invoice_url").isNotNull())
    revenue = (F.col("total").cast("decimal(18,2)") / 100).alias("revenue")
    new = live.filter(date_range(created, start, end) & kept(created) & (begin.isNull() | (begin < F.last_day(created)))).select(
        F.to_date(created).alias("day"), revenue, months_if_running_on(created, begin, finish).alias("allocation")
    )
    binned = live.withColumn("month", F.explode(_old_months(created, begin, finish, start, end)))
    month = F.col("month")
    old = binned.filter(_overlapping(created, begin, finish, month) & kept(month)).select(
        month, revenue, (service_months(created, begin, finish) * _days_in(month)).alias("allocation")
    )
    return _by_day(new, old, start, end, product_key, cost_ratio)


def agency_range(
    invoices: DataFrame, cancellations: DataFrame, start: dt.date, end: dt.date,
    cost_ratio: Decimal = COST_RATIO, product_key: str = AGENCY_KEY,
) -> DataFrame:
    """``allocate_agency`` of every day from ``start`` to ``end``."""
    issued, created = F.col("fastbill_invoice_created_at"), F.col("created_at")
    begin, finish = F.col("start_at"), F.col("end_at")
    months = months_if_running_on(created, begin, finish)
    live = invoices.filter(F.col("fastbill_invoice_number").isNotNull())
    amount = to_money(F.col("total_cost")).alias("revenue")
    new = live.filter(date_range(issued, start, end) & (begin.isNull() | (begin < F.last_day(issued)))).select(
        "id", F.to_date(issued).alias("day"), F.trunc(issued, "month").alias("month"), amount, months.alias("allocation")
    )
    binned = live.withColumn("month", F.explode(_old_months(issued, begin, finish, start, end)))
    month = F.col("month")
    old = binned.filter(_overlapping(issued, begin, finish, month)).select(
        "id", F.lit(None).cast("date").alias("day"), month, amount, (months * _days_in(month)).alias("allocation")
    )
    # A cancellation counts in its month, up to midnight of the last day.
    when = F.col("cancelled_at")
    cancelled = cancellations.filter(date_range(when, month_start(start), end.replace(day=1) + dt.timedelta(days=31))).filter(
        when <= F.last_day(when)
    ).select(F.col("individual_campaign_id").alias("__id"), F.trunc(when, "month").alias("__month")).distinct()
    kept = join_reduced(new.unionByName(old), cancelled, {"id": "__id", "month": "__month"}, "left_anti")
    is_new = F.col("day").isNotNull()
    return _by_day(kept.filter(is_new), kept.filter(~is_new), start, end, product_key, cost_ratio)


def estimates_range(products: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The report's estimates for products that have one, for every day of the range."""
    named = products.filter(F.col("avg_estimated_daily_revenues").isNotNull())
    return with_days(named, start, end, "__day").select(
        *date_keys(F.col("__day")), F.col("id").alias("product_key"),
        F.col("avg_estimated_daily_revenues").alias("revenues"), F.col("avg_estimated_daily_direct_costs").alias("direct_costs"),
    )


def report_range(
    rollups: Sequence[DataFrame], products: DataFrame, existing: DataFrame, start: dt.date, end: dt.date,
) -> DataFrame:
    """The report table after the runs of all days of the range: one staging and two merges, whatever its length.

    ``rollups`` are report rows of these days, from plans that take a range or several dates.
    """
    rows = stage(union_all(*[conform(r, REPORT.table_schema()) for r in rollups]), "report-range")
    with_estimates = merge(rows, estimates_range(products, start, end), CONTRACTS["report_estimates"].spec())
    return merge(existing, with_estimates, REPORT.spec())
