"""Approved-action state: ingest, notification digest, due actions, event log.

State is a table of tasks plus an append-only log. Every step maps a task frame
to a new one and says which log rows it adds; ``now`` is always an argument.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.dates import interval_hours, local_deadline
from adlake.functions.scalars import decode, split_list
from adlake.operators.merge import insert_if_absent
from adlake.operators.relational import join_reduced

TASK_COLUMNS = (
    """id BIGINT, advertiser_id BIGINT, publisher_id BIGINT, offer_id BIGINT, tsp BIGINT,
    offer_name STRING, publisher_name STRING, affpubid STRING,
    publisher_account_manager_name STRING, reason STRING, change_type STRING,
    delay_hours BIGINT, status STRING, email_to ARRAY<STRING>, email_cc ARRAY<STRING>,
    email_bcc ARRAY<STRING>, updated_by STRING, created_on TIMESTAMP, updated_on TIMESTAMP,
    email_sent_on TIMESTAMP"""
)

# Codes of the action source, log events, change types with a mail text.
CHANGE_TYPES = {3: "block_tsp", 6: "block_affpubid"}
STATUSES = {
    1: "registered", 0: "registered", None: "registered", 2: "success", 3: "failed",
    12: "email_success", 13: "email_failed", 22: "cancelled",
}
NEW_STATUS_CODE = 0
BLOCK_EVENTS = {"block_affpubid": "blocked_affpubid", "block_tsp": "blocked_tsp"}
MAIL_EVENT = "email_sent"
MAIL_ZONE = "Europe/Berlin"


def task_schema() -> T.StructType:
    """The task table."""
    return T.StructType.fromDDL(TASK_COLUMNS)


def decode_actions(source: DataFrame) -> DataFrame:
    """Source rows as tasks: codes to names, comma lists to arrays."""
    return source.select(
        "id", "advertiser_id", "publisher_id", "offer_id", "tsp", "offer_name", "publisher_name",
        F.col("source").alias("affpubid"),
        "publisher_account_manager_name",
        F.col("reasons").alias("reason"),
        decode(F.col("change_type"), CHANGE_TYPES).alias("change_type"),
        "delay_hours",
        decode(F.col("process_status"), STATUSES).alias("status"),
        *[split_list(F.col(c)).alias(c) for c in ("email_to", "email_cc", "email_bcc")],
        "updated_by", "created_on", "updated_on",
    )


def new_actions(source: DataFrame, run_date: dt.date) -> DataFrame:
    """Unprocessed actions created on or after the run date, as tasks."""
    fresh = (F.col("created_on") >= F.lit(run_date)) & (F.col("process_status") == NEW_STATUS_CODE)
    return decode_actions(source.filter(fresh)).withColumn(
        "email_sent_on", F.lit(None).cast("timestamp")
    )


def ingest_actions(source: DataFrame, tasks: DataFrame, run_date: dt.date) -> DataFrame:
    """Add new actions whose id is not a task yet."""
    return insert_if_absent(tasks, new_actions(source, run_date), "id")


def _to_notify() -> Column:
    return (
        (F.col("status") == "registered")
        & F.col("email_sent_on").isNull()
        & (F.col("delay_hours") > 0)
    )


def pending_notifications(tasks: DataFrame) -> DataFrame:
    """Registered tasks with a delay that nobody was mailed about."""
    return tasks.filter(_to_notify())


def digest(tasks: DataFrame, now: dt.datetime, tz: str = MAIL_ZONE) -> DataFrame:
    """The notification mails, one row per line of a mail.

    A mail is one (change_type, publisher_id). Recipients and deadline are
    those of its task with the lowest id; a change type without a mail text has
    ``has_content`` false. Lines stay rows: a publisher with very many tasks is
    never gathered in one place, and the header is found with map-side minima.
    """
    lines = pending_notifications(tasks)
    first = F.min_by(F.struct("email_to", "email_cc", "email_bcc", "delay_hours"), "id")
    headers = lines.groupBy(
        F.col("change_type").alias("__type"), F.col("publisher_id").alias("__publisher")
    ).agg(first.alias("__first"), F.count(F.lit(1)).alias("mail_lines"))
    mail = {"change_type": "__type", "publisher_id": "__publisher"}
    shown = lines.select(
        "change_type", "publisher_id", "id", "reason", "affpubid", "offer_name", "offer_id"
    )
    return join_reduced(shown, headers, mail, "inner", null_safe=True).select(
        "change_type",
        "publisher_id",
        F.col("__first.email_to").alias("email_to"),
        F.col("__first.email_cc").alias("email_cc"),
        F.col("__first.email_bcc").alias("email_bcc"),
        local_deadline(now, F.col("__first.delay_hours"), tz).alias("deadline"),
        F.coalesce(F.col("change_type").isin(list(BLOCK_EVENTS)), F.lit(False)).alias("has_content"),
        "mail_lines",
        F.col("id").alias("task_id"),
        "reason",
        "affpubid",
        "offer_name",
        "offer_id",
    )


def _is_due(now: dt.datetime) -> Column:
    clock = F.lit(now)
    passed = F.col("email_sent_on") + interval_hours(F.col("delay_hours")) < clock
    return (
        F.col("change_type").isin(list(BLOCK_EVENTS))
        & (F.col("status") == "registered")
        & ((F.col("delay_hours") == 0) | passed)
    )


def due(tasks: DataFrame, now: dt.datetime, change_type: str | None = None) -> DataFrame:
    """Registered blocking tasks without a delay, or whose delay since the mail is over."""
    rows = tasks.filter(_is_due(now))
    return rows if change_type is None else rows.filter(F.col("change_type") == change_type)


def _log(rows: DataFrame, event: Column, now: dt.datetime) -> DataFrame:
    """Log rows; the id is a hash of the content, so a retried step yields the same rows."""
    plain = rows.select(
        event.alias("event_type"),
        F.lit(None).cast("string").alias("message"),
        F.col("id").alias("task_id"),
        F.lit(now).alias("created_on"),
    )
    key = F.xxhash64("event_type", "task_id", "created_on").alias("id")
    return plain.select(key, "event_type", "message", "task_id", "created_on")


def _touch(tasks: DataFrame, condition: Column, now: dt.datetime, column: str, value: Column) -> DataFrame:
    """Set a column and the update time where the condition holds; types stay."""
    changes = {column: value, "updated_on": F.lit(now)}
    return tasks.withColumns(
        {
            name: F.when(condition, new.cast(tasks.schema[name].dataType)).otherwise(F.col(name))
            for name, new in changes.items()
        }
    )


def mark_notified(tasks: DataFrame, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Tasks with the mail time set, and a log row per mailed task."""
    log = _log(pending_notifications(tasks), F.lit(MAIL_EVENT), now)
    return _touch(tasks, _to_notify(), now, "email_sent_on", F.lit(now)), log


def apply_due(tasks: DataFrame, now: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Due tasks become ``success``; a log row per task (also in a dry run)."""
    log = _log(due(tasks, now), decode(F.col("change_type"), BLOCK_EVENTS), now)
    return _touch(tasks, _is_due(now), now, "status", F.lit("success")), log


def run_actions(
    source: DataFrame, tasks: DataFrame, run_date: dt.date, now: dt.datetime,
) -> tuple[DataFrame, DataFrame]:
    """One run: ingest, notify, act. Returns the new task table and the log rows."""
    notified, mail_log = mark_notified(ingest_actions(source, tasks, run_date), now)
    acted, block_log = apply_due(notified, now)
    return acted, mail_log.unionByName(block_log)
