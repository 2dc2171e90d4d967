"""Feature tables for the models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripflow.functions import keys
from tripflow.operators.skew import grid_left_join
from tripflow.operators.timeline import running_before

DEMAND_COLUMNS = [
    "event_date", "city_id", "completed_trips", "cancelled_trips", "gross_fare_total",
    "platform_fee_total", "driver_payout_total", "avg_surge_multiplier",
]


def demand_city_daily(mart: DataFrame) -> DataFrame:
    return mart.select(*DEMAND_COLUMNS)


def fraud_trip(fact_fraud: DataFrame, fact_trip: DataFrame) -> DataFrame:
    """Cases with the trip rows of the same trip. A trip has one row per event, so cases
    fan out, and a trip with very many events is spread on either side."""
    cases = fact_fraud.select(
        "fraud_fact_key",
        "trip_id",
        "city_key",
        "fraud_score",
        F.when(F.col("risk_band") == "high", 1).otherwise(0).alias("is_high_risk"),
    )
    trips = fact_trip.select(
        "trip_id", "final_fare", "surge_multiplier", "cancelled_flag", "completed_flag", "created_at"
    )
    joined = grid_left_join(
        cases, trips, "trip_id", ["fraud_fact_key"], ["created_at", "final_fare", "surge_multiplier"]
    )
    return joined.drop("created_at").fillna(
        {"final_fare": 0.0, "surge_multiplier": 1.0, "cancelled_flag": 0, "completed_flag": 0}
    )


def rider_churn_daily(fact_trip: DataFrame) -> DataFrame:
    """Trip events per rider and day. The label is 1 where the rider's last active day is
    more than seven days later; the name is kept although that marks a returning rider."""
    daily = fact_trip.groupBy("rider_key", F.to_date("created_at").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("trip_events")
    )
    last = F.max("activity_date").over(Window.partitionBy("rider_key"))
    late = F.date_add("activity_date", 7)
    return daily.withColumn("_last", last).select(
        "rider_key",
        "activity_date",
        "trip_events",
        F.when(F.col("_last") <= late, 0).otherwise(1).alias("churned_7d"),
    )


def rider_history(staging: DataFrame) -> DataFrame:
    """Point-in-time features: what was known of the rider before each event."""
    known = staging.filter(F.col("rider_id").isNotNull()).select(
        "event_id",
        "rider_id",
        "event_time",
        F.lit(1).cast("bigint").alias("_one"),
        F.when(F.col("event_type") == "trip_completed", 1).otherwise(0).cast("bigint").alias("_done"),
        F.when(F.col("event_type") == "trip_cancelled", 1).otherwise(0).cast("bigint").alias("_off"),
    )
    counted = running_before(
        known, "rider_id", "event_time",
        {"prior_events": "_one", "prior_completed": "_done", "prior_cancelled": "_off"},
    )
    return counted.select(
        "event_id",
        keys.md5_key("rider_id").alias("rider_key"),
        "event_time",
        "prior_events",
        "prior_completed",
        "prior_cancelled",
    )
