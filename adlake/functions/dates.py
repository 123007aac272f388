"""Calendar arithmetic and local-day handling."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UTC = ZoneInfo("UTC")


def month_key(day: Column) -> Column:
    """yyyyMM as a long."""
    return (F.year(day) * 100 + F.month(day)).cast("long")


def day_key(day: Column) -> Column:
    """yyyyMMdd as a long."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("long")


def date_keys(day: Column) -> list[Column]:
    """The four calendar columns of a report row: year, month, day, value_at."""
    return [
        F.year(day).cast("long").alias("year"),
        month_key(day).alias("month"),
        day_key(day).alias("day"),
        day.cast("date").alias("value_at"),
    ]


def local_date(ts: Column, tz: str) -> Column:
    """Calendar date in ``tz`` of a zone-less UTC timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts.cast("timestamp_ntz")))


def date_range(ts: Column, start: dt.date, end: dt.date, inclusive: bool = True) -> Column:
    """``DATE(ts)`` between two dates, written on the raw column.

    A bare comparison reaches the scan and prunes partitions; wrapping the
    column in ``to_date`` would not. Works for dates and timestamps.
    """
    stop = end + dt.timedelta(days=1) if inclusive else end
    return (ts >= F.lit(start)) & (ts < F.lit(stop))


def local_day_filter(ts: Column, tz: str, day: dt.date) -> Column:
    """Rows of one local day: exact date test plus a UTC range the scan can use.

    The range carries an hour of slack on both sides, so a clock change at
    midnight cannot cut off rows; the date test decides.
    """
    zone, slack = ZoneInfo(tz), dt.timedelta(hours=1)
    begin = dt.datetime.combine(day, dt.time(), zone).astimezone(UTC) - slack
    after = dt.datetime.combine(day + dt.timedelta(days=1), dt.time(), zone).astimezone(UTC) + slack
    lower, upper = (F.lit(x.replace(tzinfo=None)).cast("timestamp_ntz") for x in (begin, after))
    return (ts >= lower) & (ts < upper) & (local_date(ts, tz) == F.lit(day))


def compact_date(column: Column) -> Column:
    """20240131 (number or text) -> date."""
    return F.to_date(column.cast("string"), "yyyyMMdd")


def offset_timestamp(column: Column, colon: bool = True) -> Column:
    """``2024-01-31 10:00:00 +01:00`` (or ``+0100`` with ``colon=False``) -> timestamp."""
    return F.to_timestamp(column, "yyyy-MM-dd HH:mm:ss " + ("XXX" if colon else "Z"))


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def month_end(day: dt.date) -> dt.date:
    return next_month_start(day) - dt.timedelta(days=1)


def next_month_start(day: dt.date) -> dt.date:
    return (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


def previous_month_start(day: dt.date) -> dt.date:
    return month_start(month_start(day) - dt.timedelta(days=1))


def months_spanned(start: Column, end: Column) -> Column:
    """Number of calendar months touched by [start, end]; 1 within one month."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start) + 1


def with_days(df: DataFrame, start: dt.date, end: dt.date, name: str = "value_date") -> DataFrame:
    """Repeat every row once per day of [start, end] (a generator, not a join)."""
    spine = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return df.withColumn(name, F.explode(spine))


def interval_hours(hours: Column) -> Column:
    """A whole number of hours as an interval."""
    return F.make_dt_interval(hours=hours.cast("int"))


def local_deadline(now: dt.datetime, hours: Column, tz: str) -> Column:
    """``now`` + hours as local text, e.g. ``Jan 30, 2024 3:05 PM CET``.

    The zone name is the one in force at ``now``: hours are added to the wall
    clock without crossing over to another offset.
    """
    aware = (now if now.tzinfo else now.replace(tzinfo=UTC)).astimezone(ZoneInfo(tz))
    wall = F.lit(aware.replace(tzinfo=None)).cast(T.TimestampNTZType())
    text = F.date_format(wall + interval_hours(hours), "MMM d, yyyy h:mm a")
    return F.concat(text, F.lit(f" {aware.tzname()}"))
