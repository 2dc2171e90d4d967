"""Business rules declared for trips, events and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tripflow.functions.measures import count_where, money_sum
from tripflow.operators.dedup import repeated_row_count
from tripflow.operators.quality import orphans
from tripflow.settings import CANCELLED, COMPLETED, LIFECYCLE, REQUESTED, TIER_EVENTS_PER_CITY_HOUR


def alignment_rules(trips: DataFrame, cities: list[str]) -> DataFrame:
    """Violations of the five alignment rules: four in one pass, uniqueness by key."""
    inside = F.col("event_time").between(F.col("pickup_ts"), F.col("dropoff_ts"))
    parts = F.col("platform_fee") + F.col("driver_payout") + F.col("promotion_amount")
    rules = {
        # What can't be told counts as a violation.
        "AR001": ~F.coalesce(inside, F.lit(False)),
        "AR002": (F.col("distance_km") < 0) | (F.col("duration_sec") < 0),
        "AR003": F.abs(F.col("fare_total") - parts) > 0.01,
        "AR004": ~F.coalesce(F.col("city_id").isin(cities), F.lit(False)),
    }
    counts = trips.agg(*[count_where(cond).alias(rule) for rule, cond in rules.items()])
    lines = F.array(
        *[
            F.struct(F.lit(rule).alias("rule_id"), F.col(rule).alias("violations"))
            for rule in rules
        ]
    )
    repeats = repeated_row_count(trips, ["event_id"], "violations")
    return counts.select(F.inline(lines)).unionByName(
        repeats.select(F.lit("AR005").alias("rule_id"), "violations")
    )


def source_rules(source: DataFrame, columns: dict[str, str], required: list[str]) -> DataFrame:
    """Checks of a raw source: columns present, start before end, nothing negative."""
    missing = len([c for c in required if c not in source.columns])
    counts = source.agg(
        count_where(F.col(columns["start"]) > F.col(columns["end"])).alias("start_before_end"),
        count_where(F.col(columns["fare"]) < 0).alias("non_negative_fare"),
        count_where(F.col(columns["distance"]) < 0).alias("non_negative_distance"),
    )
    lines = F.array(
        F.struct(
            F.lit("required_columns_present").alias("rule_id"),
            F.lit(missing).cast("bigint").alias("violations"),
        ),
        *[
            F.struct(F.lit(rule).alias("rule_id"), F.col(rule).alias("violations"))
            for rule in ("start_before_end", "non_negative_fare", "non_negative_distance")
        ],
    )
    return counts.select(F.inline(lines))


def extended_daily_kpis(
    staging: DataFrame, request: str = REQUESTED, arrival: str = "driver_arrived"
) -> DataFrame:
    """Requests, completion rate and waiting time per city and day.

    A trip waits from its first request to its first arrival, be it after midnight; the wait belongs
    to the city and day of the request.
    """
    kind = F.col("event_type")
    place = ["event_date", "city_id"]
    counts = staging.groupBy(*place).agg(
        count_where(kind == request).alias("total_requests"),
        count_where(kind == COMPLETED).alias("completed_trips"),
    )
    asked = F.min(F.when(kind == request, F.struct("event_time", *place)))
    waits = (
        staging.filter(F.col("trip_id").isNotNull() & kind.isin(request, arrival))
        .groupBy("trip_id")
        .agg(asked.alias("asked"), F.min(F.when(kind == arrival, F.col("event_time"))).alias("arrived"))
        .filter(F.col("arrived") >= F.col("asked.event_time"))
        .groupBy(*[F.col(f"asked.{c}").alias(f"_{c}") for c in place])
        .agg(
            F.sum(F.unix_micros("arrived") - F.unix_micros("asked.event_time")).alias("_micros"),
            F.count(F.lit(1)).alias("_waits"),
        )
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place]
    rate = F.col("completed_trips") / F.nullif(F.col("total_requests"), F.lit(0).cast("bigint"))
    return counts.join(waits, same, "left").select(
        *place,
        "total_requests",
        "completed_trips",
        F.round(rate, 6).alias("completion_rate"),
        F.round(F.col("_micros") / F.lit(60_000_000.0) / F.col("_waits"), 6).alias("avg_wait_minutes"),
    )


def kpi_catalogue(staging: DataFrame) -> DataFrame:
    """Ratios per city: take rate, cancellation rate, tickets per 1,000 trips, mean rating."""
    kind = F.col("event_type")
    done = count_where(kind == COMPLETED)
    off = count_where(kind == CANCELLED)
    zero = F.lit(0).cast("bigint")
    sums = staging.groupBy("city_id").agg(
        money_sum(F.col("fare_total")).alias("gross_bookings"),
        money_sum(F.col("platform_fee")).alias("_fees"),
        money_sum(F.col("promotion_amount")).alias("_promotions"),
        money_sum(F.col("refund_amount")).alias("_refunds"),
        done.alias("completed_trips"),
        off.alias("_cancelled"),
        F.count("support_ticket_id").alias("_tickets"),
        F.round(F.avg("rating_value"), 6).alias("avg_rating"),
    )
    net = F.col("_fees") - F.col("_promotions") - F.col("_refunds")
    finished = F.nullif(F.col("completed_trips") + F.col("_cancelled"), zero)
    return sums.select(
        "city_id",
        "gross_bookings",
        F.round(net, 6).alias("net_revenue"),
        F.round(net / F.nullif(F.col("gross_bookings"), F.lit(0.0)), 6).alias("take_rate"),
        F.round(F.col("_cancelled") / finished, 6).alias("cancellation_rate"),
        F.round(
            F.lit(1000.0) * F.col("_tickets") / F.nullif(F.col("completed_trips"), zero), 6
        ).alias("tickets_per_1000_trips"),
        "avg_rating",
    )


def relationship_failures(pairs: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Orphan keys and the rows that hold them, per (fact, dimension, key)."""
    result = None
    for fact_name, fact, dim_name, dimension, key in pairs:
        one = orphans(fact, dimension, key).agg(
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("orphan_rows"),
        ).select(
            F.lit(fact_name).alias("fact"), F.lit(dim_name).alias("dimension"),
            "orphan_keys", "orphan_rows",
        )
        result = one if result is None else result.unionByName(one)
    return result


def lifecycle_breaks(events: DataFrame, states: list[str] = LIFECYCLE) -> DataFrame:
    """Trips that enter a state before having left an earlier one.

    Ordered by time, a trip's states never step back exactly when every state
    begins no earlier than all states before it end. So a trip needs only the
    first and last time of each state, a handful of rows however many events
    it has, and no window over its events.
    """
    position = F.array_position(F.array(*[F.lit(s) for s in states]), F.col("event_type"))
    spans = (
        events.filter(F.col("trip_id").isNotNull())
        .withColumn("state", position.cast("int"))
        .filter(F.col("state") > 0)
        .groupBy("trip_id", "state")
        .agg(F.min("event_time").alias("first_at"), F.max("event_time").alias("last_at"))
    )
    before = (
        Window.partitionBy("trip_id").orderBy("state").rowsBetween(Window.unboundedPreceding, -1)
    )
    compared = spans.withColumn("reached", F.max("last_at").over(before))
    names = F.array(*[F.lit(s) for s in states])
    return (
        compared.filter(F.col("reached") > F.col("first_at"))
        .groupBy("trip_id")
        .agg(F.count(F.lit(1)).alias("breaks"), F.min("state").alias("_state"))
        .select("trip_id", "breaks", F.element_at(names, F.col("_state")).alias("first_break"))
    )


def capacity_use(
    staging: DataFrame, tier_of_city: dict[str, str], default_tier: str = "pilot"
) -> DataFrame:
    """Events per city and hour against the hourly limit of the city's tier."""
    tier = F.lit(default_tier)
    for city, name in tier_of_city.items():
        tier = F.when(F.col("city_id") == city, name).otherwise(tier)
    limit = None
    for name, most in TIER_EVENTS_PER_CITY_HOUR.items():
        here = F.col("tier") == name
        limit = F.when(here, most) if limit is None else limit.when(here, most)
    hours = staging.groupBy(
        "city_id", F.date_trunc("hour", "event_time").alias("event_hour")
    ).agg(F.count(F.lit(1)).alias("events"))
    return hours.withColumn("tier", tier).withColumn(
        "hour_limit", limit.cast("bigint")
    ).withColumn("within_limit", F.col("events") <= F.col("hour_limit"))


def volume_anomalies(
    staging: DataFrame, hours: int = 24, low: float = 0.5, high: float = 2.0
) -> DataFrame:
    """City-hours whose event count leaves the band around the mean of the hours before,
    with the share of NULL riders and of high-risk cases. A window holds one city's hours."""
    grouped = staging.groupBy(
        "city_id", F.date_trunc("hour", "event_time").alias("event_hour")
    ).agg(
        F.count(F.lit(1)).alias("events"),
        F.round(F.avg(F.when(F.col("rider_id").isNull(), 1.0).otherwise(0.0)), 6).alias(
            "null_rider_share"
        ),
        count_where(F.col("fraud_score") >= 0.8).alias("high_risk_cases"),
    )
    before = (
        Window.partitionBy("city_id")
        .orderBy(F.unix_seconds("event_hour"))
        .rangeBetween(-hours * 3600, -1)
    )
    trailing = grouped.withColumn("trailing_mean", F.round(F.avg("events").over(before), 6))
    unusual = (F.col("events") < F.col("trailing_mean") * low) | (
        F.col("events") > F.col("trailing_mean") * high
    )
    return trailing.withColumn("is_anomaly", F.coalesce(unusual, F.lit(False)))


def surge_out_of_bounds(staging: DataFrame, low: float = 1.0, high: float = 5.0) -> DataFrame:
    outside = ~F.col("surge_multiplier").between(low, high)
    return staging.groupBy("city_id").agg(
        F.count("surge_multiplier").alias("checked"), count_where(outside).alias("violations")
    )
