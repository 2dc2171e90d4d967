"""Aggregates and labels shared by the marts, stores and features."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tripflow.settings import HIGH_RISK, MEDIUM_RISK


_EXACT = "decimal(28,6)"


def money_sum(value: Column) -> Column:
    """Sum with NULL as zero. Millionths are added as decimals, so task order cannot show."""
    return F.sum(F.coalesce(value, F.lit(0.0)).cast(_EXACT)).cast("double")


def mean(value: Column) -> Column:
    """Mean of the values that are not NULL, over an exact sum."""
    return F.round(F.sum(value.cast(_EXACT)).cast("double") / F.count(value), 6)


def two_places(value: Column) -> Column:
    return F.round(F.round(value, 6), 2)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def risk_band(score: Column) -> Column:
    """A missing score counts as zero and is low."""
    filled = F.coalesce(score, F.lit(0.0))
    return (
        F.when(filled >= HIGH_RISK, "high").when(filled >= MEDIUM_RISK, "medium").otherwise("low")
    )


def risk_band_or_unknown(score: Column) -> Column:
    return F.when(score.isNull(), "unknown").otherwise(risk_band(score))


def ratio(part: Column, whole: Column) -> Column:
    """NULL where the whole is zero."""
    return part / F.nullif(whole, F.lit(0).cast("double"))
