"""Event time, calendar parts and relative time. All in UTC session time."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(ts_ms: Column) -> Column:
    return F.timestamp_millis(ts_ms)


def year_month(ts_ms: Column) -> Column:
    """yyyyMM bucket of an epoch-millisecond event time."""
    return F.date_format(event_time(ts_ms), "yyyyMM")


def iso_micros(ts_ms: Column, default: Column | None = None) -> Column:
    """ISO-8601 text with six fraction digits and Z; missing or 0 gives ``default`` (now)."""
    fallback = F.current_timestamp() if default is None else default
    when = F.coalesce(event_time(F.nullif(ts_ms, F.lit(0))), fallback)
    return F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd").cast("int")


def iso_week(ts: Column) -> Column:
    """ISO year and week as one number, 2024-12-30 gives 202501."""
    return (F.extract(F.lit("YEAROFWEEK"), ts) * 100 + F.weekofyear(ts)).cast("int")


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:00")


def hour_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded folder parts of an hour."""
    patterns = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {name: F.date_format(ts, pattern) for name, pattern in patterns.items()}


def instant(text: str) -> datetime:
    """'2024-01-31 00:00:00' as an aware UTC datetime, the form every ``as_of`` takes."""
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc)
