"""Conversion export for an external fraud check."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.dates import date_range

# Event types that are not exported.
EXCLUDED_EVENTS = ("dzlft", "dy5lk", "alltac")


def conversion_export(
    conversions: DataFrame, event_types: DataFrame, offers: DataFrame, run_date: dt.date,
    country: str = "JP", exclude: Sequence[str] = EXCLUDED_EVENTS, ordered: bool = True,
) -> DataFrame:
    """Conversions of one country and partition day with event names, latest first.

    Rows with equal times are ordered by session, which also lets the sort
    split a crowded moment over several partitions.
    """
    # A NULL event type is neither in the list nor outside it: such rows are out.
    rows = conversions.filter(
        date_range(F.col("partition_time"), run_date, run_date)
        & (F.col("country") == country)
        & ~F.col("event_type").isin(list(exclude))
    )
    named = rows.join(event_types.select("event_type", "event_name"), "event_type", "left").join(
        offers.select("offer_id"), F.col("network_offer_id") == F.col("offer_id"), "left"
    )
    export = named.select(
        F.col("date").alias("time"),
        F.col("network_affiliate_id").alias("external_publisher_id"),
        F.col("source_id").alias("external_media_id"),
        F.col("app_id").alias("external_site_id"),
        F.col("network_offer_id").alias("external_sub_site_id"),
        F.col("network_offer_id").alias("campaign_id"),
        F.when(F.col("cpa_enabled") == 1, "cpa").otherwise("cpi").alias("campaign_type"),
        F.col("event_name").alias("conversion_type"),
        F.lit("clicks").alias("attribution_type"),
        F.col("click_date").alias("attribution_time"),
        F.col("session_user_ip").alias("ip"),
        F.when(F.col("platform") == "iOS", F.col("idfa")).otherwise(F.col("google_ad_id")).alias("device_id"),
        F.col("click_ua").alias("user_agent"),
        F.col("isp").alias("carrier"),
        "referer",
        "platform",
        F.col("handset").alias("device_type"),
        "os_version",
        "language",
        F.col("is_wireless_device").alias("wifi"),
        F.col("transaction_id").alias("session_id"),
    )
    return export.orderBy(F.col("time").desc(), "session_id") if ordered else export
