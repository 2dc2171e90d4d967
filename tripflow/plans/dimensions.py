"""Dimensions of the star schema."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripflow.functions import calendar, keys


def _no_time() -> Column:
    return F.lit(None).cast("timestamp")


def _now(as_of: datetime | None) -> Column:
    return F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()


def dim_city(staging: DataFrame) -> DataFrame:
    return (
        staging.select("city_id")
        .filter(F.col("city_id").isNotNull())
        .distinct()
        .select(
            keys.md5_key("city_id").alias("city_key"),
            "city_id",
            F.col("city_id").alias("city_name"),
            F.lit("NA").alias("country_code"),
            F.lit("UTC").alias("timezone"),
            F.lit("default").alias("region_cluster"),
            F.lit("standard").alias("regulatory_tier"),
        )
    )


def _first_days(staging: DataFrame, person: str, day: str) -> DataFrame:
    """One row per person and city with the person's first day anywhere.

    Events shrink to a row per person and city before the window, so a busy
    person costs its window task only as many rows as there are cities.
    """
    by_city = (
        staging.filter(F.col(person).isNotNull())
        .groupBy(person, "city_id")
        .agg(F.min("event_date").alias("_first"))
    )
    return by_city.select(
        person, "city_id", F.min("_first").over(Window.partitionBy(person)).alias(day)
    )


def dim_rider(staging: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return _first_days(staging, "rider_id", "signup_date").select(
        keys.md5_key("rider_id").alias("rider_key"),
        "rider_id",
        "signup_date",
        F.lit("standard").alias("rider_segment"),
        keys.md5_key("city_id").alias("city_key"),
        F.lit("active").alias("lifecycle_status"),
        _now(as_of).alias("effective_from"),
        _no_time().alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def dim_driver(staging: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return _first_days(staging, "driver_id", "onboarding_date").select(
        keys.md5_key("driver_id").alias("driver_key"),
        "driver_id",
        "onboarding_date",
        F.lit("standard").alias("driver_tier"),
        keys.md5_key("city_id").alias("city_key"),
        F.lit("active").alias("lifecycle_status"),
        F.lit("unrated").alias("rating_band"),
        _now(as_of).alias("effective_from"),
        _no_time().alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def dim_vehicle(staging: DataFrame) -> DataFrame:
    return (
        staging.select("vehicle_id")
        .filter(F.col("vehicle_id").isNotNull())
        .distinct()
        .select(
            keys.md5_key("vehicle_id").alias("vehicle_key"),
            "vehicle_id",
            F.lit("sedan").alias("vehicle_type"),
            F.lit("unknown").alias("make"),
            F.lit("unknown").alias("model"),
            F.lit(2024).alias("model_year"),
            F.lit(4).alias("capacity"),
        )
    )


def dim_time(staging: DataFrame) -> DataFrame:
    """Hours that occur; the calendar parts are worked out once per hour, not per event."""
    hour = F.col("_hour")
    return (
        staging.filter(F.col("event_time").isNotNull())
        .select(F.date_trunc("hour", "event_time").alias("_hour"))
        .distinct()
        .select(
            calendar.time_key(hour).alias("time_key"),
            F.to_date(hour).alias("full_date"),
            F.hour(hour).alias("hour_of_day"),
            calendar.day_of_week(hour).alias("day_of_week"),
            F.weekofyear(hour).alias("week_of_year"),
            F.month(hour).alias("month_of_year"),
            F.quarter(hour).alias("quarter_of_year"),
            F.year(hour).alias("year_number"),
            F.lit(False).alias("is_holiday"),
        )
    )


def dim_promotion(staging: DataFrame) -> DataFrame:
    """Amounts that occur. The earliest event is a scalar over the grouped rows,
    not a window without a partition, which would move every event to one task."""
    amounts = staging.groupBy("promotion_amount").agg(F.min("event_time").alias("_first"))
    earliest = amounts.agg(F.min("_first").alias("_earliest"))
    code = keys.promotion_code(F.col("promotion_amount"))
    return amounts.select(
        keys.md5_key(code).alias("promotion_key"),
        F.concat(F.lit("promo_"), code).alias("promotion_id"),
        F.lit("dynamic").alias("campaign_type"),
        F.lit("amount").alias("discount_type"),
        F.coalesce(F.col("promotion_amount"), F.lit(0.0)).alias("cap_amount"),
        earliest.scalar().alias("valid_from"),
        _no_time().alias("valid_to"),
    ).distinct()


def dim_payment_method(staging: DataFrame) -> DataFrame:
    return (
        staging.select(keys.method_code(F.col("source_system")).alias("method_code"))
        .distinct()
        .select(
            keys.md5_key("method_code").alias("payment_method_key"),
            "method_code",
            F.lit("mixed").alias("method_type"),
            F.lit("platform").alias("provider"),
            F.lit("standard").alias("risk_profile"),
        )
    )


def driver_history(staging: DataFrame) -> DataFrame:
    """City assignments of drivers over time, one row per stay (type-2 history)."""
    from tripflow.operators.timeline import value_periods

    known = staging.filter(F.col("driver_id").isNotNull())
    periods = value_periods(known, "driver_id", "city_id", "event_time", "event_id")
    return periods.select(
        keys.md5_key("driver_id").alias("driver_key"),
        "driver_id",
        "city_id",
        F.col("valid_from").alias("effective_from"),
        F.col("valid_to").alias("effective_to"),
        F.col("valid_to").isNull().alias("is_current"),
    )
