"""One row per key.

The rank filter is what Spark turns into a group limit ahead of the shuffle:
a task sends at most one row per key, however many copies of a key it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _first_ranked(frame: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return frame.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_last(frame: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    return _first_ranked(frame, key, [F.col(c).desc_nulls_last() for c in by])


def keep_first(frame: DataFrame, key: list[str], by: list[str]) -> DataFrame:
    return _first_ranked(frame, key, [F.col(c).asc_nulls_last() for c in by])


def first_arrivals(messages: DataFrame, key: str = "event_id") -> DataFrame:
    """First copy of each non-empty id in topic order."""
    present = messages.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return keep_first(present, [key], ["partition", "offset"])


def repeated_row_count(frame: DataFrame, key: list[str], name: str = "duplicate_rows") -> DataFrame:
    """Number of rows whose key occurs more than once, every copy counted."""
    groups = frame.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"))
    total = F.sum(F.when(F.col("_copies") > 1, F.col("_copies")).otherwise(0))
    return groups.agg(F.coalesce(total, F.lit(0)).cast("bigint").alias(name))
