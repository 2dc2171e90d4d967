"""Casts that turn unusable text into NULL instead of failing under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _filled(value: Column) -> Column:
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def to_double(value: Column) -> Column:
    return _filled(value).try_cast("double")


def to_long(value: Column) -> Column:
    return _filled(value).try_cast("bigint")


def to_time(value: Column) -> Column:
    """ISO-8601 text, with ``Z`` or an offset, as a UTC timestamp."""
    return F.try_to_timestamp(_filled(value))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def zero_as_missing(value: Column) -> Column:
    return F.nullif(value, F.lit(0.0))
