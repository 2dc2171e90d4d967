"""Operational documents: fraud cases, support tickets, rider sessions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.functions.coerce import zero_as_missing
from tripflow.functions.measures import count_where, risk_band_or_unknown
from tripflow.settings import CANCELLED, COMPLETED, FRAUD_TYPES, REQUESTED, SESSION_TYPES, TICKET_TYPES


def _stamp(at: datetime | None) -> Column:
    return F.lit(at).cast("timestamp") if at is not None else F.current_timestamp()


def fraud_cases(staging: DataFrame, synced_at: datetime | None = None) -> DataFrame:
    """Zero scores and fares count as missing; so does a zero surge, which becomes 1."""
    return staging.filter(F.col("event_type").isin(FRAUD_TYPES)).select(
        F.col("event_id").alias("fraud_case_id"),
        "trip_id",
        "driver_id",
        "rider_id",
        "city_id",
        "event_type",
        "event_time",
        zero_as_missing(F.col("fraud_score")).alias("fraud_score"),
        zero_as_missing(F.col("fare_total")).alias("final_fare"),
        F.coalesce(zero_as_missing(F.col("surge_multiplier")), F.lit(1.0)).alias(
            "surge_multiplier"
        ),
        "source_system",
        risk_band_or_unknown(F.col("fraud_score")).alias("risk_band"),
        _stamp(synced_at).alias("synced_at"),
    )


def support_tickets(staging: DataFrame, synced_at: datetime | None = None) -> DataFrame:
    trip = F.coalesce(F.col("trip_id"), F.lit("None"))
    return staging.filter(F.col("event_type").isin(TICKET_TYPES)).select(
        F.col("event_id").alias("support_ticket_id"),
        "trip_id",
        "rider_id",
        "driver_id",
        "city_id",
        F.col("event_type").alias("issue_type"),
        F.concat(
            F.lit("Auto-synced from Silver: "), F.col("event_type"), F.lit(" for trip "), trip
        ).alias("description"),
        F.lit("open").alias("status"),
        "event_time",
        "source_system",
        _stamp(synced_at).alias("synced_at"),
    )


def rider_sessions(staging: DataFrame, synced_at: datetime | None = None) -> DataFrame:
    kind = F.col("event_type")
    sessions = (
        staging.filter(F.col("rider_id").isNotNull() & kind.isin(SESSION_TYPES))
        .groupBy("rider_id", "city_id")
        .agg(
            count_where(kind == REQUESTED).alias("total_requests"),
            count_where(kind == COMPLETED).alias("total_completions"),
            count_where(kind == CANCELLED).alias("total_cancellations"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("event_time"),
        )
    )
    rate = F.col("total_completions") / F.greatest(F.col("total_requests"), F.lit(1))
    city = F.coalesce(F.col("city_id"), F.lit("None"))
    return sessions.select(
        F.concat_ws("_", F.lit("session"), "rider_id", city).alias("session_id"),
        "rider_id",
        "city_id",
        "total_requests",
        "total_completions",
        "total_cancellations",
        F.round(rate, 3).alias("completion_rate"),
        "first_seen",
        "event_time",
        _stamp(synced_at).alias("synced_at"),
    )


def as_documents(frame: DataFrame, key: str) -> DataFrame:
    """Key plus the row as one JSON document."""
    return frame.select(key, F.to_json(F.struct("*")).alias("document"))


def store_totals(stores: dict[str, DataFrame]) -> DataFrame:
    """Documents per collection."""
    counts = None
    for name, frame in stores.items():
        one = frame.agg(F.count(F.lit(1)).alias("documents")).select(
            F.lit(name).alias("collection"), "documents"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


TICKET_FIELDS = ["support_ticket_id", "rider_id", "city_id", "issue_type", "description"]


def accepted_tickets(requests: DataFrame, at: datetime | None = None) -> DataFrame:
    """Handed-in tickets with every required field; status and time get defaults."""
    complete = requests
    for name in TICKET_FIELDS:
        complete = complete.filter(F.col(name).isNotNull())
    return complete.withColumns(
        {
            "status": F.coalesce("status", F.lit("open")),
            "event_time": F.coalesce("event_time", _stamp(at)),
            "created_at": _stamp(at),
        }
    )


def rejected_tickets(requests: DataFrame) -> DataFrame:
    """The others, each with the sorted names of what is missing."""
    gaps = F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in sorted(TICKET_FIELDS)]),
        lambda name: name.isNotNull(),
    )
    return requests.withColumn("missing_fields", F.array_join(gaps, ",")).filter(
        F.col("missing_fields") != ""
    )
