"""Data-quality rules over marts and column tests over models."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from tripflow import schemas
from tripflow.functions.measures import count_where

KPI_ENTITY = "gold.mart_city_daily_kpis"


def kpi_checks(
    mart: DataFrame,
    run_id: str,
    as_of: date,
    observed_at: datetime,
    max_age_days: int = 1,
    by_city: bool = False,
) -> DataFrame:
    """Not empty, fresh, no negative fares: all three from one aggregate.

    With ``by_city`` each city gets its own results, with the city in the run id.
    """
    oldest = F.date_sub(F.lit(as_of), max_age_days)
    measures = [
        F.count(F.lit(1)).alias("rows"),
        F.max("event_date").alias("latest"),
        count_where(F.col("gross_fare_total") < 0).alias("negative"),
    ]
    found = mart.groupBy("city_id").agg(*measures) if by_city else mart.agg(*measures)
    run = F.concat(F.lit(f"{run_id}-"), F.col("city_id")) if by_city else F.lit(run_id)
    fresh = F.coalesce(F.col("latest") >= oldest, F.lit(False))

    def outcome(rule: str, count: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule_id"), count.cast("bigint").alias("violation_count"))

    outcomes = F.array(
        outcome("kpi_table_not_empty", F.when(F.col("rows") > 0, 0).otherwise(1)),
        outcome("kpi_table_freshness", F.when(fresh, 0).otherwise(1)),
        outcome("kpi_negative_fares", F.col("negative")),
    )
    lines = found.select(run.alias("run_id"), F.inline(outcomes))
    status = F.when(F.col("violation_count") == 0, "passed").otherwise("failed")
    return lines.select(
        *[
            {
                "target_entity": F.lit(KPI_ENTITY),
                "status": status,
                "observed_at": F.lit(observed_at).cast("timestamp"),
            }.get(f.name, F.col(f.name)).alias(f.name)
            for f in schemas.QUALITY_RESULT.fields
        ]
    )


def verdict(results: DataFrame) -> DataFrame:
    """One row per run: counts of checks and the run status."""
    failed = count_where(F.col("status") == "failed")
    return results.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_checks"),
        failed.alias("failed_checks"),
        (F.count(F.lit(1)) - failed).alias("passed_checks"),
        F.when(failed == 0, "success").otherwise("failed").alias("status"),
    )


class QualityFailure(RuntimeError):
    """At least one rule found violations."""


def require_pass(results: DataFrame) -> None:
    """Raise with every failing rule and its violations; there are as many lines as rules."""
    failing = (
        results.filter(F.col("status") == "failed")
        .groupBy("rule_id")
        .agg(F.sum("violation_count").alias("violations"))
        .orderBy("rule_id")
        .collect()
    )
    if failing:
        raise QualityFailure(", ".join(f"{r['rule_id']}={r['violations']}" for r in failing))


def pass_rate_by(results: DataFrame, key: str, threshold: float) -> DataFrame:
    rate = F.avg(F.when(F.col("status") == "passed", 1.0).otherwise(0.0))
    return results.groupBy(key).agg(F.round(rate, 6).alias("pass_rate")).withColumn(
        "meets_threshold", F.col("pass_rate") >= threshold
    )


# Column tests --------------------------------------------------------------

# Tests each model declares.
COLUMN_TESTS = {
    "silver_canonical_events": {
        "event_id": ["not_null", "unique"], "event_time": ["not_null"], "city_id": ["not_null"],
    },
    "stg_silver_canonical_events": {
        "event_id": ["not_null", "unique"], "event_time": ["not_null"], "city_id": ["not_null"],
    },
    "dim_city": {"city_key": ["not_null", "unique"], "city_id": ["not_null"]},
    "dim_rider": {"rider_key": ["not_null", "unique"], "rider_id": ["not_null"]},
    "dim_driver": {"driver_key": ["not_null", "unique"], "driver_id": ["not_null"]},
    "dim_vehicle": {"vehicle_key": ["not_null", "unique"], "vehicle_id": ["not_null"]},
    "dim_promotion": {"promotion_key": ["not_null", "unique"]},
    "dim_payment_method": {"payment_method_key": ["not_null", "unique"]},
    "dim_time": {"time_key": ["not_null", "unique"]},
    "fact_trip": {"trip_fact_key": ["not_null", "unique"], "trip_id": ["not_null"]},
    "fact_driver_earnings": {"earning_fact_key": ["not_null", "unique"], "trip_id": ["not_null"]},
    "fact_payment": {"payment_fact_key": ["not_null", "unique"], "payment_id": ["not_null"]},
    "fact_review": {"review_fact_key": ["not_null", "unique"], "review_id": ["not_null"]},
    "fact_fraud": {"fraud_fact_key": ["not_null", "unique"], "fraud_case_id": ["not_null"]},
    "fact_operational_event": {
        "operational_event_fact_key": ["not_null", "unique"], "event_id": ["not_null"],
    },
    "mart_city_daily_kpis": {"event_date": ["not_null"], "city_id": ["not_null"]},
}


def column_tests(model: str, frame: DataFrame, tests: dict[str, list[str]]) -> DataFrame:
    """Failures per declared test: NULL rows, or distinct values that repeat.

    A model declares at most one unique column. Grouping by it shrinks the
    frame to one row per value, and the NULL counts ride along as sums.
    """
    unique = [c for c, kinds in tests.items() if "unique" in kinds]
    nulls = {c: f"_null_{c}" for c, kinds in tests.items() if "not_null" in kinds}
    null_counts = [count_where(F.col(c).isNull()).alias(a) for c, a in nulls.items()]
    outcomes = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit("not_null").alias("test"),
            F.coalesce(F.sum(a) if unique else F.first(a), F.lit(0)).cast("bigint").alias("failures"),
        )
        for c, a in nulls.items()
    ]
    if unique:
        key = unique[0]
        groups = frame.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), *null_counts)
        repeated = count_where((F.col("_copies") > 1) & F.col(key).isNotNull())
        outcomes.append(
            F.struct(
                F.lit(key).alias("column_name"), F.lit("unique").alias("test"),
                repeated.cast("bigint").alias("failures"),
            )
        )
        counted = groups.agg(F.array(*outcomes).alias("_outcomes"))
    else:
        counted = frame.agg(*null_counts).agg(F.array(*outcomes).alias("_outcomes"))
    return counted.select(F.lit(model).alias("model"), F.inline("_outcomes"))


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct known fact keys without a dimension row; facts shrink to keys first."""
    held = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return held.join(dimension.select(key).distinct(), key, "left_anti")
