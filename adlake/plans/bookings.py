"""Monthly bookings spread over the days of the year so far."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.dates import (
    date_keys, month_key, month_start, previous_month_start, with_days,
)
from adlake.functions.scalars import rounded, slug

# Booking names outside this report and the key prefix.
EXCLUDED_PRODUCTS = ("0406 - Third Party Supply", "0407 - Portal - Performance")
KEY_PREFIX = "AS"


def _monthly(
    revenue: DataFrame, cost: DataFrame, exclude: Sequence[str], year: int,
) -> DataFrame:
    """Revenue and cost per product key and month, from last December on.

    Both tables are stacked, each with a 0 for the other's measure, so a month
    booked on one side only is not NULL on the other. Rows shrink to one per
    product name and month before the name is turned into a key.
    """
    name, day = F.col("product_name"), F.col("booking_period_date")
    stacked = (
        revenue.select(name, day, "revenue").withColumn("cost", F.lit(0))
        .unionByName(cost.select(name, day, "cost").withColumn("revenue", F.lit(0)))
    )
    window = (day >= F.lit(dt.date(year - 1, 12, 1))) & (day < F.lit(dt.date(year + 1, 1, 1)))
    totals = [F.sum(c).alias(c) for c in ("revenue", "cost")]
    by_name = stacked.filter(~name.isin(list(exclude)) & window).groupBy(
        "product_name", month_key(day).alias("booking_month")
    ).agg(*totals)
    key = slug(name, KEY_PREFIX).alias("product_key")
    return by_name.groupBy(key, "booking_month").agg(*totals)


def _products(revenue: DataFrame, exclude: Sequence[str]) -> DataFrame:
    names = revenue.filter(~F.col("product_name").isin(list(exclude))).select("product_name").distinct()
    return names.select(slug(F.col("product_name"), KEY_PREFIX).alias("product_key")).distinct()


def spread_monthly(
    revenue: DataFrame, cost: DataFrame, run_date: dt.date,
    exclude: Sequence[str] = EXCLUDED_PRODUCTS, per_product: bool = False,
) -> DataFrame:
    """One row per product and day from 1 January to the run date.

    A past month's bookings are divided by its length, the current month's by
    the days elapsed. A current month without bookings takes the previous
    month: over all products, divided by its days and by the number of products
    (``per_product`` takes the product's own previous month instead). Revenue
    and cost are judged separately; a past month without bookings stays NULL.
    Products are those the revenue table names.
    """
    monthly = _monthly(revenue, cost, exclude, run_date.year)
    products = _products(revenue, exclude)
    previous = previous_month_start(run_date)
    previous_key = previous.year * 100 + previous.month
    previous_days = (month_start(run_date) - previous).days
    last_month = monthly.filter(F.col("booking_month") == previous_key)

    days = with_days(products, run_date.replace(month=1, day=1), run_date)
    days = days.withColumn("booking_month", month_key(F.col("value_date")))
    rows = days.join(monthly, ["product_key", "booking_month"], "left")
    if per_product:
        own = last_month.select("product_key", F.struct("revenue", "cost").alias("__before"))
        rows = rows.join(own, "product_key", "left")
        before, sharers = F.col("__before"), F.lit(1)
    else:
        totals = F.struct(F.sum("revenue").alias("revenue"), F.sum("cost").alias("cost"))
        before = last_month.agg(totals.alias("totals")).scalar()
        sharers = products.agg(F.count(F.lit(1)).alias("n")).scalar()

    current = F.col("value_date") >= F.lit(month_start(run_date))
    length = F.dayofmonth(F.last_day("value_date"))

    def daily(amount: str) -> Column:
        booked = F.col(amount)
        fallback = before[amount].cast("double") / previous_days / sharers
        return (
            F.when(current & (F.coalesce(booked, F.lit(0)) == 0), fallback)
            .when(current, rounded(booked / run_date.day))
            .otherwise(rounded(booked / length))
        )

    return rows.select(
        *date_keys(F.col("value_date")),
        "product_key",
        daily("revenue").alias("revenues"),
        daily("cost").alias("direct_costs"),
    )
