"""Dashboard and API queries over marts, facts, stores and audit tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.functions.measures import count_where, ratio, two_places


def clamp(limit: int, most: int) -> int:
    return max(1, min(limit, most))


def _latest(frame: DataFrame, column: str) -> Column:
    return F.col(column) == frame.agg(F.max(column)).scalar()


# City KPIs -----------------------------------------------------------------


def city_daily(mart: DataFrame, limit: int = 30) -> DataFrame:
    return mart.orderBy(F.desc("event_date"), F.asc("city_id")).limit(clamp(limit, 365))


def kpi_table(mart: DataFrame) -> DataFrame:
    return mart.select(
        "city_id",
        "event_date",
        "completed_trips",
        "cancelled_trips",
        *[
            two_places(F.col(c)).alias(c)
            for c in (
                "gross_fare_total",
                "platform_fee_total",
                "driver_payout_total",
                "avg_surge_multiplier",
            )
        ],
    ).orderBy(F.desc("event_date"), "city_id")


def time_series(mart: DataFrame, measure: str, rounded: bool = False) -> DataFrame:
    value = two_places(F.col(measure)) if rounded else F.col(measure)
    return mart.select(
        F.col("event_date").alias("time"), F.col("city_id").alias("metric"), value.alias("value")
    ).orderBy("time", "metric")


def latest_day(mart: DataFrame, staging: DataFrame, measure: str, name: str) -> DataFrame:
    """One measure per city on the last day; the day is read from the partition column,
    so the mart below is computed from that day's files only."""
    value = F.col(measure)
    value = value.cast("double") if measure == "completed_trips" else two_places(value)
    return (
        mart.filter(F.col("event_date") == staging.agg(F.max("event_date")).scalar())
        .select(F.col("city_id").alias("metric"), value.alias(name))
        .orderBy("metric")
    )


# Fraud ---------------------------------------------------------------------


def fraud_count(fact_fraud: DataFrame, name: str, condition: Column | None = None) -> DataFrame:
    rows = fact_fraud if condition is None else fact_fraud.filter(condition)
    return rows.agg(F.count(F.lit(1)).alias(name))


def average_fraud_score(fact_fraud: DataFrame) -> DataFrame:
    return fact_fraud.agg(F.round(F.round(F.avg("fraud_score"), 6), 3).alias("avg_fraud_score"))


def fraud_by_band_and_city(fact_fraud: DataFrame, dim_city: DataFrame) -> DataFrame:
    """Cases shrink to a row per band and city key before they meet the dimension."""
    grouped = fact_fraud.groupBy("risk_band", "city_key").agg(
        F.count(F.lit(1)).alias("_cases"),
        F.sum("fraud_score").alias("_score"),
        count_where(F.col("blocked_flag")).alias("_blocked"),
    )
    cities = dim_city.select(F.md5(F.col("city_id").cast("binary")).alias("city_key"), "city_id")
    mean_score = F.sum("_score") / F.sum("_cases")
    return (
        grouped.join(cities, "city_key", "left")
        .groupBy("risk_band", "city_id")
        .agg(
            F.sum("_cases").alias("cases"),
            F.round(F.round(mean_score, 6), 3).alias("avg_score"),
            F.sum("_blocked").alias("blocked"),
        )
        .orderBy(F.desc("risk_band"), "city_id")
    )


def fraud_by_day(fact_fraud: DataFrame) -> DataFrame:
    return (
        fact_fraud.groupBy(
            F.date_trunc("day", "created_at").alias("time"), F.col("risk_band").alias("metric")
        )
        .agg(F.count(F.lit(1)).alias("value"))
        .orderBy("time", "metric")
    )


# Riders --------------------------------------------------------------------


def churned_riders(churn: DataFrame) -> DataFrame:
    return churn.filter(_latest(churn, "activity_date")).agg(
        F.sum("churned_7d").alias("churned_riders")
    )


def active_riders(churn: DataFrame) -> DataFrame:
    return churn.filter(_latest(churn, "activity_date") & (F.col("trip_events") > 0)).agg(
        F.countDistinct("rider_key").alias("active_riders")
    )


def churn_rate(churn: DataFrame) -> DataFrame:
    share = ratio(F.lit(100.0) * F.sum("churned_7d"), F.count(F.lit(1)).cast("double"))
    return churn.filter(_latest(churn, "activity_date")).agg(
        F.round(share, 1).alias("churn_rate_pct")
    )


def active_and_churned(churn: DataFrame) -> DataFrame:
    active = (
        churn.filter(F.col("trip_events") > 0)
        .groupBy("activity_date")
        .agg(F.countDistinct("rider_key").cast("double").alias("value"))
        .select(F.col("activity_date").alias("time"), F.lit("active_riders").alias("metric"), "value")
    )
    churned = (
        churn.groupBy("activity_date")
        .agg(F.sum("churned_7d").cast("double").alias("value"))
        .select(F.col("activity_date").alias("time"), F.lit("churned_riders").alias("metric"), "value")
    )
    return active.unionByName(churned).orderBy("time", "metric")


# Stores --------------------------------------------------------------------


def newest(
    documents: DataFrame, key: str, limit: int = 20, most: int = 200, **equal: str | None
) -> DataFrame:
    """Newest documents; filters apply only where a value is given."""
    rows = documents
    for name, value in equal.items():
        if value:
            rows = rows.filter(F.col(name) == value)
    return rows.orderBy(F.desc("event_time"), key).limit(clamp(limit, most))


# Audit ---------------------------------------------------------------------


def latest_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    return runs.select(
        "run_id", "pipeline_name", "stage_name", "status", "started_at", "ended_at", "details"
    ).orderBy(F.desc("started_at"), "run_id").limit(clamp(limit, 200))


def recent_runs_panel(runs: DataFrame, limit: int = 20) -> DataFrame:
    minute = "yyyy-MM-dd HH:mm"
    seconds = F.get_json_object("details", "$.duration_seconds").try_cast("double")
    return (
        runs.orderBy(F.desc("started_at"), "run_id")
        .limit(limit)
        .select(
            F.date_format("started_at", minute).alias("started"),
            F.col("pipeline_name").alias("pipeline"),
            F.col("stage_name").alias("stage"),
            "status",
            F.date_format("ended_at", minute).alias("ended"),
            F.round(seconds, 2).alias("duration_s"),
            "run_id",
        )
    )


def latest_quality(results: DataFrame, limit: int = 20) -> DataFrame:
    return results.select(
        "run_id", "rule_id", "target_entity", "status", "violation_count", "observed_at"
    ).orderBy(F.desc("observed_at"), "run_id", "rule_id").limit(clamp(limit, 200))


def recent_quality_panel(results: DataFrame, limit: int = 20) -> DataFrame:
    return (
        results.orderBy(F.desc("observed_at"), "run_id", "rule_id")
        .limit(limit)
        .select(
            F.date_format("observed_at", "yyyy-MM-dd HH:mm").alias("checked_at"),
            "run_id",
            F.col("rule_id").alias("rule"),
            F.col("target_entity").alias("target"),
            "status",
            F.col("violation_count").alias("violations"),
        )
    )
