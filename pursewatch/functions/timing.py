"""Time arithmetic. The reference time is always an argument, so a query repeats exactly."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from pursewatch.model import EPOCH, SPEND_WINDOW_DAYS


def moment(value: datetime | str) -> Column:
    """A timestamp without zone from a datetime or its text."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def window_start(as_of: datetime | str, days: int = SPEND_WINDOW_DAYS) -> Column:
    return moment(as_of) - F.make_dt_interval(F.lit(days))


def day_of(ts: Column) -> Column:
    """Midnight of the day, without a zone; ``date_trunc`` would go through the session's."""
    return ts.cast("date").cast("timestamp_ntz")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds that passed, not second boundaries crossed."""
    return F.timestamp_diff("SECOND", start, end)


def ingest_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def watermark_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def or_epoch(watermark: Column) -> Column:
    return F.coalesce(watermark, moment(EPOCH))


def as_utc_instant(ts: Column) -> Column:
    """The zoned timestamp that reads the same in UTC, whatever the session zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", moment(EPOCH), ts))


def from_utc_instant(ts: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), moment(EPOCH))
