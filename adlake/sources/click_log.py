"""The nested, day-partitioned click log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.schema import check_required
from adlake.sources.writers import with_day, write_parquet

# Columns of the click log, partitioned by the day of ts.
CLICK_LOG_COLUMNS = """
    id STRING NOT NULL, ts TIMESTAMP NOT NULL, sent_at TIMESTAMP NOT NULL, isp STRING,
    service_id BIGINT, campaign_id STRING, traffic_id STRING, external_id STRING,
    target_url STRING, requested_with STRING, user_agent STRING, owpub_id STRING,
    owsubpub_id STRING, tsp STRING, owoffer_id STRING, owadv_id STRING,
    processing_result STRUCT<score: BIGINT NOT NULL, fingerprint: STRING, redirect_url: STRING,
        token: STRING, strategies: ARRAY<STRUCT<strategy: STRING NOT NULL,
        score: BIGINT NOT NULL, decision: STRING NOT NULL, reason: STRING>>,
        decision: STRING NOT NULL, action: STRING NOT NULL> NOT NULL,
    request STRUCT<url: STRING NOT NULL, headers: ARRAY<STRUCT<key: STRING NOT NULL,
        value: STRING>>, parameters: ARRAY<STRUCT<key: STRING NOT NULL,
        value: ARRAY<STRING>>>, remote_address: STRING> NOT NULL,
    device STRUCT<device_os_version: STRING, is_mobile: BOOLEAN, mobile_browser: STRING,
        device_os: STRING, model_name: STRING, brand_name: STRING> NOT NULL,
    country_iso_name STRING, policy_id BIGINT,
    whitelisting_result STRUCT<applied_whitelists: ARRAY<STRUCT<key: STRING NOT NULL,
        value: ARRAY<STRING>>>, is_whitelisted: BOOLEAN NOT NULL> NOT NULL
"""


def click_log_schema() -> T.StructType:
    return T.StructType.fromDDL(CLICK_LOG_COLUMNS)


def write_click_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write clicks partitioned by day; a crowded day is split over several writers."""
    rows = check_required(df, click_log_schema())
    write_parquet(with_day(rows, "ts"), path, partition_by=("dt",), mode=mode)


def read_click_log(
    spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None,
) -> DataFrame:
    """Clicks of the days [start, end]; other days' files are not opened."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.filter(F.col("dt") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("dt") <= F.lit(end))
    return df


def strategies(clicks: DataFrame) -> DataFrame:
    """One row per click and scoring strategy."""
    return clicks.select(
        F.col("id").alias("click_id"), F.explode("processing_result.strategies").alias("s")
    ).select("click_id", "s.strategy", "s.score", "s.decision", "s.reason")


def parameters_map(clicks: DataFrame) -> DataFrame:
    """Request parameters as a map from key to its list of values."""
    entries = F.transform("request.parameters", lambda p: F.struct(p["key"], p["value"]))
    return clicks.select(F.col("id").alias("click_id"), F.map_from_entries(entries).alias("parameters"))
