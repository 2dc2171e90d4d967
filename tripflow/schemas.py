"""Declared schemas; nothing in the package infers one."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(text: str) -> T.StructType:
    fields = [part.split() for part in text.replace("\n", " ").split(",")]
    kinds = {
        "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
        "double": T.DoubleType(), "timestamp": T.TimestampType(), "date": T.DateType(),
        "boolean": T.BooleanType(), "binary": T.BinaryType(),
    }
    return T.StructType([T.StructField(name, kinds[kind], True) for name, kind in fields])


# What a topic delivers, for topics kept as files; the folder names the topic.
FILE_ENVELOPE = _struct(
    """key string, value string, partition int, offset bigint, timestamp timestamp,
       timestampType int"""
)

BRONZE = _struct(
    """topic string, partition int, offset bigint, kafka_timestamp timestamp,
       timestampType int, key string, value string, ingestion_time timestamp,
       bronze_entity string"""
)

PAYLOAD_STRINGS = [
    "trip_id", "rider_id", "driver_id", "vehicle_id", "city_id", "payment_id",
    "refund_id", "review_id", "support_ticket_id", "fraud_case_id",
]
PAYLOAD_DOUBLES = [
    "fare_total", "surge_multiplier", "promotion_amount", "platform_fee",
    "driver_payout", "payment_amount", "refund_amount", "rating_value",
    "fraud_score", "latitude", "longitude", "avg_surge_multiplier",
]
PAYLOAD_LONGS = ["requested_trips", "completed_trips", "active_drivers"]

SILVER = _struct(
    "source_topic string, bronze_entity string, ingestion_time timestamp, "
    "event_id string, event_type string, event_time timestamp, "
    + ", ".join(f"{c} string" for c in PAYLOAD_STRINGS) + ", "
    + ", ".join(f"{c} double" for c in PAYLOAD_DOUBLES) + ", "
    + ", ".join(f"{c} bigint" for c in PAYLOAD_LONGS) + ", "
    + "source_system string, schema_version string, raw_payload string, event_date date"
)

# Warehouse input: 30 columns plus the event date.
STAGING = _struct(
    "event_id string, event_type string, event_time timestamp, city_id string, "
    + ", ".join(f"{c} string" for c in PAYLOAD_STRINGS if c != "city_id") + ", "
    + ", ".join(f"{c} double" for c in PAYLOAD_DOUBLES) + ", "
    + ", ".join(f"{c} bigint" for c in PAYLOAD_LONGS) + ", "
    + "source_system string, schema_version string, event_date date"
)

TRIP = _struct(
    """event_id string, trip_id string, rider_id string, driver_id string, city_id string,
       event_type string, event_time timestamp, pickup_ts timestamp, dropoff_ts timestamp,
       pickup_lat double, pickup_lng double, dropoff_lat double, dropoff_lng double,
       distance_km double, duration_sec double, ingestion_time timestamp, fare_total double,
       surge_multiplier double, promotion_amount double, platform_fee double,
       driver_payout double, payment_method_code string, source_system string,
       source_record_id string, schema_version string"""
)

GOLD_HOURLY = _struct(
    """city_id string, window_start timestamp, window_end timestamp, completed_trips bigint,
       cancelled_trips bigint, gross_fare_total double, platform_fee_total double,
       driver_payout_total double, avg_surge_multiplier double, event_date date"""
)

RUN_EVENT = _struct(
    """run_id string, pipeline_name string, stage_name string, status string,
       at timestamp, details string"""
)

QUALITY_RESULT = _struct(
    """run_id string, rule_id string, target_entity string, status string,
       violation_count bigint, observed_at timestamp"""
)

CORPUS = _struct(
    """id string, source_id string, target_table string, source_type string,
       city_id string, doc_id string, text string"""
)
