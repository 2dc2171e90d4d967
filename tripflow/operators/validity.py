"""Split of canonical rows into usable and quarantined."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.settings import REQUIRED_EVENT_FIELDS


def is_valid(required: list[str] = REQUIRED_EVENT_FIELDS) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])


def valid_rows(frame: DataFrame, required: list[str] = REQUIRED_EVENT_FIELDS) -> DataFrame:
    return frame.filter(is_valid(required))


def quarantined_rows(frame: DataFrame, required: list[str] = REQUIRED_EVENT_FIELDS) -> DataFrame:
    return frame.filter(~is_valid(required))
