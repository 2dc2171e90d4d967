"""Fixed values and default parameters."""

from __future__ import annotations

# Topic name and the bronze entity it lands in.
TOPICS = [
    {"name": "rh.trip.lifecycle.events.v1", "bronze_entity": "op_trip_events"},
    {"name": "rh.driver.location.pings.v1", "bronze_entity": "op_driver_location_events"},
    {"name": "rh.rider.app.events.v1", "bronze_entity": "op_rider_app_events"},
    {"name": "rh.payment.transactions.v1", "bronze_entity": "op_payment_events"},
    {"name": "rh.pricing.surge.signals.v1", "bronze_entity": "op_surge_pricing_events"},
    {"name": "rh.promotion.events.v1", "bronze_entity": "op_promotion_events"},
    {"name": "rh.refund.events.v1", "bronze_entity": "op_refund_events"},
    {"name": "rh.review.events.v1", "bronze_entity": "op_review_events"},
    {"name": "rh.earnings.events.v1", "bronze_entity": "op_driver_earnings_events"},
    {"name": "rh.incentive.events.v1", "bronze_entity": "op_incentive_events"},
    {"name": "rh.fraud.signals.v1", "bronze_entity": "op_fraud_signal_events"},
    {"name": "rh.support.tickets.v1", "bronze_entity": "op_support_ticket_events"},
    {"name": "rh.geo.events.v1", "bronze_entity": "op_geo_events"},
    {"name": "rh.city.agg.events.v1", "bronze_entity": "op_city_agg_events"},
    {"name": "rh.revenue.margin.events.v1", "bronze_entity": "op_revenue_margin_events"},
]
ENTITY_OF_TOPIC = {t["name"]: t["bronze_entity"] for t in TOPICS}

REQUIRED_EVENT_FIELDS = ["event_id", "event_time", "city_id"]
WATERMARK = "30 minutes"

# Event types a store or a measure selects.
COMPLETED = "trip_completed"
CANCELLED = "trip_cancelled"
REQUESTED = "ride_requested"
FRAUD_TYPES = ["fraud_signal", "ghost_trip_detected", "fraud_detected"]
TICKET_TYPES = ["support_ticket_created", "complaint_raised", "refund_requested"]
SESSION_TYPES = [REQUESTED, COMPLETED, CANCELLED]

# Score at or above which a case gets the band.
HIGH_RISK = 0.8
MEDIUM_RISK = 0.5

KM_PER_MILE = 1.60934
PLATFORM_FEE_SHARE = 0.20

# Lifecycle states in the order a trip passes them.
LIFECYCLE = [
    "quote_requested",
    "quote_generated",
    "ride_requested",
    "driver_assigned",
    "driver_en_route",
    "driver_arrived",
    "trip_started",
    "trip_in_progress",
    "trip_completed",
    "payment_authorized",
    "payment_captured",
    "payout_calculated",
    "payout_disbursed",
    "review_submitted",
    "support_case_opened",
    "refund_processed",
]

# City registry and capacity tiers.
CITY_REGISTRY = [
    {"city_id": "NYC", "tier": "scaled", "enabled": True, "open_data": "nyc_tlc"},
    {"city_id": "CHICAGO", "tier": "scaled", "enabled": True, "open_data": "chicago_taxi"},
    {"city_id": "SF", "tier": "pilot", "enabled": False, "open_data": "pending"},
]
TIER_EVENTS_PER_CITY_HOUR = {"pilot": 10_000, "scaled": 100_000, "enterprise": 500_000}
MIN_QUALITY_PASS_RATE = 0.99

# Contract of the canonical trip table.
TRIP_CONTRACT = {
    "contract_name": "op_trip_events",
    "version": "1.0.0",
    "primary_key": ["event_id"],
    "required_fields": [
        "event_id", "trip_id", "rider_id", "driver_id", "city_id", "event_type",
        "event_time", "pickup_ts", "dropoff_ts", "distance_km", "duration_sec",
        "fare_total", "source_system", "source_record_id", "schema_version",
    ],
    "field_types": {
        "event_id": "string",
        "trip_id": "string",
        "rider_id": "string",
        "driver_id": "string",
        "city_id": "string",
        "event_type": "string",
        "event_time": "timestamp",
        "pickup_ts": "timestamp",
        "dropoff_ts": "timestamp",
        "pickup_lat": "float|null",
        "pickup_lng": "float|null",
        "dropoff_lat": "float|null",
        "dropoff_lng": "float|null",
        "distance_km": "float",
        "duration_sec": "float",
        "ingestion_time": "timestamp",
        "fare_total": "float",
        "surge_multiplier": "float",
        "promotion_amount": "float",
        "platform_fee": "float",
        "driver_payout": "float",
        "payment_method_code": "string",
        "source_system": "string",
        "source_record_id": "string",
        "schema_version": "string",
    },
    "quality_rules": {
        "not_null": ["event_id", "trip_id", "city_id", "event_time", "source_system", "schema_version"],
        "non_negative": ["distance_km", "duration_sec", "fare_total", "platform_fee", "driver_payout"],
        "allowed": {
            "event_type": ["trip_completed"],
            "city_id": ["NYC", "CHICAGO", "SF"],
        },
    },
}

# Features of each model, in the order the vector holds them.
MODEL_FEATURES = {
    "demand_model": [
        "cancelled_trips", "gross_fare_total", "platform_fee_total",
        "driver_payout_total", "avg_surge_multiplier",
    ],
    "surge_model": ["completed_trips", "cancelled_trips", "gross_fare_total", "driver_payout_total"],
    "fraud_model": ["fraud_score", "final_fare", "surge_multiplier", "cancelled_flag", "completed_flag"],
    "churn_model": ["trip_events"],
}

# Upper bounds in seconds of the latency histogram, before +Inf.
LATENCY_BUCKETS = [
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
]
MAX_ERROR_RATIO = 0.05
MAX_P95_SECONDS = 1.5

EMBEDDING_DIM = 256
DEFAULT_TOP_K = 5
