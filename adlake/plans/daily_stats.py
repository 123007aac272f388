"""Daily click, event and revenue statistics per offer, advertiser, affiliate, tsp, country."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.dates import date_range
from adlake.functions.scalars import count_if, rounded

KEYS = ["date", "offer_id", "advertiser_id", "affiliate_id", "tsp", "country_code"]
COUNTS = ["clicks", "events", "approved_events", "rejected_events", "pending_events"]
MONEY = ["revenue", "payout", "profit"]
COLUMNS = [*KEYS, "tracker", *COUNTS, *MONEY]


def _window(df: DataFrame, run_date: dt.date, days: int) -> DataFrame:
    return df.filter(
        date_range(F.col("partition_time"), run_date - dt.timedelta(days=days), run_date)
    )


def _tail(clicks: Column, events: Column, approved: Column, rejected: Column, pending: Column,
          revenue: Column, payout: Column, profit: Column) -> list[Column]:
    counts = [c.cast("long").alias(n) for c, n in zip((clicks, events, approved, rejected, pending), COUNTS)]
    money = [rounded(c).alias(n) for c, n in zip((revenue, payout, profit), MONEY)]
    return counts + money


def daily_stats(
    clicks: DataFrame, conversions: DataFrame, run_date: dt.date, days: int = 7,
    combine: bool = False, tracker: str = "DASH",
) -> DataFrame:
    """Statistics of the ``days`` before the run date and the run date itself.

    By default click groups and event groups are separate rows, so a key with
    both has two. ``combine`` gives one row per key: rows of both inputs are
    stacked before one aggregation, which costs a single shuffle.
    """
    day = F.to_date("partition_time").alias("date")
    click_rows = _window(clicks, run_date, days).select(
        day, *KEYS[1:], F.col("transaction_id").isNotNull().cast("long").alias("is_click")
    )
    event_rows = _window(conversions, run_date, days).select(
        day,
        F.col("network_offer_id").alias("offer_id"),
        F.col("network_advertiser_id").alias("advertiser_id"),
        F.col("network_affiliate_id").alias("affiliate_id"),
        "tsp",
        F.col("country").alias("country_code"),
        F.col("conversion_id").isNotNull().cast("long").alias("is_event"),
        F.col("conversion_status").alias("status"),
        "revenue",
        "payout",
    )
    zero = F.lit(0)
    n_clicks, n_events = F.sum("is_click"), F.sum("is_event")
    approved, rejected, pending = (
        count_if(F.col("status") == s) for s in ("approved", "rejected", "pending")
    )
    revenue, payout = F.sum("revenue"), F.sum("payout")
    if combine:
        rows = click_rows.unionByName(event_rows, allowMissingColumns=True)
        filled = [F.coalesce(c, zero) for c in (revenue, payout, revenue - payout)]
        stats = rows.groupBy(KEYS).agg(
            *_tail(F.coalesce(n_clicks, zero), F.coalesce(n_events, zero), approved, rejected, pending, *filled)
        )
    else:
        by_click = click_rows.groupBy(KEYS).agg(*_tail(n_clicks, *[zero] * 7))
        by_event = event_rows.groupBy(KEYS).agg(
            *_tail(zero, n_events, approved, rejected, pending, revenue, payout, revenue - payout)
        )
        stats = by_click.unionByName(by_event)
    return stats.withColumn("tracker", F.lit(tracker)).select(COLUMNS)
