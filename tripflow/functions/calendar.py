"""Calendar parts of an event time, in UTC."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, functions as F


def time_key(ts: Column) -> Column:
    """YYYYMMDDHH as a number, by integer arithmetic instead of formatting."""
    day = F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)
    return day.cast("bigint") * 100 + F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(ts) - 1


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)


def parse_day(value: str) -> date:
    """``YYYY-MM-DD`` or ``today`` (UTC)."""
    if value.strip().lower() == "today":
        return datetime.now(timezone.utc).date()
    return datetime.strptime(value, "%Y-%m-%d").date()


def on_day(ts: Column, day: date) -> Column:
    """Half-open range on the bare column, so that the scan can skip row groups."""
    start = datetime(day.year, day.month, day.day)
    following = start + timedelta(days=1)
    return (ts >= F.lit(start.strftime("%Y-%m-%d 00:00:00")).cast("timestamp")) & (
        ts < F.lit(following.strftime("%Y-%m-%d 00:00:00")).cast("timestamp")
    )
