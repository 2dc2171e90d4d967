"""Facts of the star schema: one projection each, loaded whole or incrementally."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.functions import calendar, coerce, keys
from tripflow.functions.measures import flag, risk_band
from tripflow.settings import CANCELLED, COMPLETED, HIGH_RISK


def _md5(name: str) -> Column:
    return keys.md5_key(name)


def _own_or_event(name: str) -> Column:
    return F.coalesce(F.col(name), F.col("event_id"))


def _amount(name: str) -> Column:
    return coerce.or_zero(F.col(name))


def _zero() -> Column:
    return F.lit(0.0)


def _hour() -> Column:
    return calendar.time_key(F.col("event_time"))


def _method() -> Column:
    return keys.md5_key(keys.method_code(F.col("source_system")))


def _trip_columns() -> dict[str, Column]:
    return {
        "trip_fact_key": keys.md5_key(_own_or_event("trip_id")),
        "trip_id": F.col("trip_id"),
        "rider_key": _md5("rider_id"),
        "driver_key": _md5("driver_id"),
        "vehicle_key": _md5("vehicle_id"),
        "city_key": _md5("city_id"),
        "time_key": _hour(),
        "promotion_key": keys.md5_key(keys.promotion_code(F.col("promotion_amount"))),
        "payment_method_key": _method(),
        "final_fare": _amount("fare_total"),
        "surge_multiplier": F.coalesce(F.col("surge_multiplier"), F.lit(1.0)),
        "promotion_amount": _amount("promotion_amount"),
        "platform_fee": _amount("platform_fee"),
        "driver_payout": _amount("driver_payout"),
        "completed_flag": flag(F.col("event_type") == COMPLETED),
        "cancelled_flag": flag(F.col("event_type") == CANCELLED),
        "created_at": F.col("event_time"),
    }


def _earnings_columns() -> dict[str, Column]:
    return {
        "earning_fact_key": keys.md5_key(F.concat(_own_or_event("trip_id"), F.lit("_earn"))),
        "trip_id": F.col("trip_id"),
        "driver_key": _md5("driver_id"),
        "city_key": _md5("city_id"),
        "time_key": _hour(),
        "base_earning": _amount("driver_payout"),
        "surge_bonus": _zero(),
        "incentive_bonus": _zero(),
        "tip_amount": _zero(),
        "adjustment_amount": _zero(),
        "net_driver_earning": _amount("driver_payout"),
        "created_at": F.col("event_time"),
    }


def _payment_columns() -> dict[str, Column]:
    return {
        "payment_fact_key": keys.md5_key(_own_or_event("payment_id")),
        "payment_id": F.col("payment_id"),
        "trip_id": F.col("trip_id"),
        "rider_key": _md5("rider_id"),
        "city_key": _md5("city_id"),
        "time_key": _hour(),
        "payment_method_key": _method(),
        "captured_amount": _amount("payment_amount"),
        "refunded_amount": _amount("refund_amount"),
        "chargeback_amount": _zero(),
        "fee_amount": _zero(),
        "created_at": F.col("event_time"),
    }


def _review_columns() -> dict[str, Column]:
    return {
        "review_fact_key": keys.md5_key(_own_or_event("review_id")),
        "review_id": F.col("review_id"),
        "trip_id": F.col("trip_id"),
        "rider_key": _md5("rider_id"),
        "driver_key": _md5("driver_id"),
        "city_key": _md5("city_id"),
        "time_key": _hour(),
        "rating_value": _amount("rating_value"),
        "sentiment_score": _zero(),
        "created_at": F.col("event_time"),
    }


def _fraud_columns() -> dict[str, Column]:
    return {
        "fraud_fact_key": keys.md5_key(_own_or_event("fraud_case_id")),
        "fraud_case_id": F.col("fraud_case_id"),
        "trip_id": F.col("trip_id"),
        "rider_key": _md5("rider_id"),
        "driver_key": _md5("driver_id"),
        "city_key": _md5("city_id"),
        "time_key": _hour(),
        "fraud_score": _amount("fraud_score"),
        "risk_band": risk_band(F.col("fraud_score")),
        "blocked_flag": _amount("fraud_score") >= HIGH_RISK,
        "created_at": F.col("event_time"),
    }


def _operational_columns() -> dict[str, Column]:
    return {
        "operational_event_fact_key": _md5("event_id"),
        "event_id": F.col("event_id"),
        "trip_id": F.col("trip_id"),
        "rider_key": _md5("rider_id"),
        "driver_key": _md5("driver_id"),
        "city_key": _md5("city_id"),
        "time_key": _hour(),
        "event_type": F.col("event_type"),
        "event_count": F.lit(1),
        "latency_ms": F.lit(0),
        "source_system": F.col("source_system"),
        "created_at": F.col("event_time"),
    }


@dataclass(frozen=True)
class Fact:
    """A fact table: its unique key, the columns that must be known, its projection."""

    key: str
    known: tuple[str, ...]
    columns: Callable[[], dict[str, Column]]

    def build(self, staging: DataFrame, newer_than=None) -> DataFrame:
        """All rows, or those whose event is later than the high-water mark."""
        rows = staging
        for name in self.known:
            rows = rows.filter(F.col(name).isNotNull())
        if newer_than is not None:
            rows = rows.filter(F.col("event_time") > F.lit(newer_than).cast("timestamp"))
        return rows.select(*[c.alias(name) for name, c in self.columns().items()])


FACTS = {
    "fact_trip": Fact("trip_fact_key", ("trip_id",), _trip_columns),
    "fact_driver_earnings": Fact("earning_fact_key", ("driver_id", "trip_id"), _earnings_columns),
    "fact_payment": Fact("payment_fact_key", ("payment_id",), _payment_columns),
    "fact_review": Fact("review_fact_key", ("review_id",), _review_columns),
    "fact_fraud": Fact("fraud_fact_key", ("fraud_case_id",), _fraud_columns),
    "fact_operational_event": Fact(
        "operational_event_fact_key", ("event_id",), _operational_columns
    ),
}


def fact(name: str, staging: DataFrame, newer_than=None) -> DataFrame:
    return FACTS[name].build(staging, newer_than)
