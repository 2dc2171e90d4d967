"""City KPIs by hour and by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tripflow import schemas
from tripflow.functions.measures import count_where, mean, money_sum
from tripflow.settings import CANCELLED, COMPLETED


def kpi_measures(completed_only: bool = False) -> list[Column]:
    """Money counts every event type unless only completed trips are asked for."""

    def money(name: str) -> Column:
        value = F.col(name)
        if completed_only:
            value = F.when(F.col("event_type") == COMPLETED, value)
        return money_sum(value).alias(f"{'gross_fare' if name == 'fare_total' else name}_total")

    return [
        count_where(F.col("event_type") == COMPLETED).alias("completed_trips"),
        count_where(F.col("event_type") == CANCELLED).alias("cancelled_trips"),
        money("fare_total"),
        money("platform_fee"),
        money("driver_payout"),
        mean(F.coalesce(F.col("surge_multiplier"), F.lit(1.0))).alias("avg_surge_multiplier"),
    ]


def city_hourly(events: DataFrame) -> DataFrame:
    """Tumbling hour windows; the same plan serves the stream."""
    hours = events.groupBy(F.window("event_time", "1 hour"), "city_id").agg(*kpi_measures())
    start = F.col("window.start")
    return hours.select(
        *[
            {
                "window_start": start,
                "window_end": F.col("window.end"),
                "event_date": F.to_date(start),
            }.get(f.name, F.col(f.name)).alias(f.name)
            for f in schemas.GOLD_HOURLY.fields
        ]
    )


def city_daily_kpis(staging: DataFrame, completed_only: bool = False) -> DataFrame:
    return staging.groupBy("event_date", "city_id").agg(*kpi_measures(completed_only))


def trailing_demand(mart: DataFrame, days: int = 7) -> DataFrame:
    """Averages over the ``days`` calendar days before each day; a partition holds one city's days."""
    before = (
        Window.partitionBy("city_id")
        .orderBy(F.datediff("event_date", F.lit("1970-01-01").cast("date")))
        .rangeBetween(-days, -1)
    )
    per_trip = F.sum("gross_fare_total").over(before) / F.nullif(
        F.sum("completed_trips").over(before), F.lit(0)
    )
    return mart.select(
        "event_date",
        "city_id",
        "completed_trips",
        F.round(F.avg("completed_trips").over(before), 6).alias("trailing_avg_trips"),
        F.round(per_trip, 6).alias("trailing_avg_fare"),
    )
