"""Literal trips through silver, facts and marts."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripflow import schemas, settings
from tripflow.operators import contracts
from tripflow.operators.conform import to_staging
from tripflow.operators.validity import quarantined_rows, valid_rows
from tripflow.plans import facts, gold, store
from tripflow.plans.silver import to_canonical


def canonical(spark, payloads):
    rows = [
        ("rh.trip.lifecycle.events.v1", 0, i, datetime(2026, 6, 16), 0, None,
         p if isinstance(p, str) else json.dumps(p), datetime(2026, 6, 17, 0, 0, i), "op_trip_events")
        for i, p in enumerate(payloads)
    ]
    return to_canonical(spark.createDataFrame(rows, schemas.BRONZE))


def trip(number, kind, minute, fare=None, **more):
    money = (
        {"fare_total": fare, "platform_fee": fare * 0.25, "driver_payout": fare * 0.75} if fare else {}
    )
    return {
        "event_id": f"one-{number}", "trip_id": "trip-one", "rider_id": "rider-one",
        "driver_id": "driver-one", "vehicle_id": "vehicle-one", "city_id": "NYC",
        "event_type": kind, "event_time": f"2026-06-16T09:{minute:02d}:00+00:00",
        "surge_multiplier": 1.0, "promotion_amount": 0.0, "source_system": "producer", **money, **more,
    }


HAPPY_TRIP = [
    trip(1, "ride_requested", 0), trip(2, "driver_assigned", 1), trip(3, "trip_started", 6),
    trip(4, "trip_completed", 24, 21.0), trip(5, "payment_captured", 25, 21.0),
    trip(6, "review_submitted", 26),
]


def staged(spark, payloads):
    return to_staging(canonical(spark, payloads), ["ingestion_time"])


def test_happy_trip(spark):
    rows = staged(spark, HAPPY_TRIP)
    assert rows.count() == 6
    fact = facts.fact("fact_trip", rows).filter("completed_flag = 1").first()
    assert (fact["final_fare"], fact["platform_fee"], fact["driver_payout"]) == (21.0, 5.25, 15.75)
    kpi = gold.city_daily_kpis(rows).first()
    assert kpi["completed_trips"] == 1
    # The fare stands on completion and on capture, and both count.
    assert kpi["gross_fare_total"] == 42.0
    assert gold.city_daily_kpis(rows, completed_only=True).first()["gross_fare_total"] == 21.0


def test_surge_trip(spark):
    rows = staged(spark, [trip(1, "trip_completed", 5, 25.2, surge_multiplier=1.8)])
    fact = facts.fact("fact_trip", rows).first()
    assert (fact["surge_multiplier"], fact["final_fare"]) == (1.8, 25.2)


def test_fraud_case(spark):
    rows = staged(spark, [trip(1, "fraud_signal", 31, 95.0, fraud_case_id="case-1", fraud_score=0.92)])
    fact = facts.fact("fact_fraud", rows).first()
    assert (fact["risk_band"], fact["blocked_flag"]) == ("high", True)
    case = store.fraud_cases(rows).first()
    assert (case["risk_band"], case["fraud_score"], case["final_fare"]) == ("high", 0.92, 95.0)


@pytest.mark.parametrize(
    "score, in_fact, in_store",
    [(None, "low", "unknown"), (0.0, "low", "low"), (0.5, "medium", "medium"), (0.8, "high", "high")],
)
def test_risk_bands(staging, score, in_fact, in_store):
    rows = staging(
        {"event_id": "a", "event_type": "fraud_signal", "fraud_case_id": "c", "fraud_score": score,
         "event_time": "2026-06-16T10:00:00", "city_id": "NYC"}
    )
    assert facts.fact("fact_fraud", rows).first()["risk_band"] == in_fact
    assert store.fraud_cases(rows).first()["risk_band"] == in_store


def test_driver_earnings_hold_the_payout_only(spark):
    rows = staged(spark, [trip(1, "trip_completed", 5, 24.0, incentive_amount=3.0)])
    fact = facts.fact("fact_driver_earnings", rows).first()
    assert (fact["net_driver_earning"], fact["incentive_bonus"]) == (18.0, 0.0)


BAD_TRIP = {
    "trip_id": "bad-1", "event_id": "bad-1-e", "event_type": "trip_completed",
    "fare_amount": "18.50", "fare_total": "18.50", "city_id": None, "rider_id": "r", "driver_id": "d",
    "event_time": "2026-06-17T10:00:00Z", "source_system": "test", "schema_version": "bad_v0",
}


def test_contract_finds_exactly_two_errors(spark):
    frame = spark.createDataFrame([tuple(BAD_TRIP.values())], ", ".join(f"{c} string" for c in BAD_TRIP))
    summary = contracts.validate(frame, settings.TRIP_CONTRACT)
    assert summary["errors"] == [
        "Missing required columns: ['pickup_ts', 'dropoff_ts', 'distance_km', 'duration_sec', "
        "'source_record_id']",
        "Column 'city_id' has 1 null values",
    ]
    assert (summary["valid"], summary["row_count"], summary["error_count"]) == (False, 1, 2)
    with pytest.raises(contracts.ContractViolation):
        contracts.gate(frame, settings.TRIP_CONTRACT, "enforce")
    assert contracts.gate(frame, settings.TRIP_CONTRACT, "warn")["mode"] == "warn"


def test_contract_checks_types_values_and_keys(spark):
    frame = spark.createDataFrame(
        [("a", "NYC", "x", "1.5", "yesterday"), ("a", "MARS", "-2", "2", "2026-01-01"), (None, "PLUTO", None, "-1", None)],
        "id string, city string, amount string, count string, at string",
    )
    contract = {
        "primary_key": ["id"],
        "field_types": {"amount": "float", "count": "integer", "at": "timestamp", "city": "string"},
        "quality_rules": {"not_null": ["id"], "non_negative": ["amount", "count"], "allowed": {"city": ["NYC"]}},
    }
    assert contracts.validate(frame, contract)["errors"] == [
        "Column 'id' has 1 null values",
        "Column 'amount' has 1 negative values",
        "Column 'count' has 1 negative values",
        "Column 'city' has 2 distinct disallowed values in 2 rows",
        "Primary key ['id'] has 2 duplicate rows",
        "Column 'amount' has 1 non-float values",
        "Column 'at' has 1 non-timestamp values",
    ]


def test_contract_lists_every_value_however_many(spark, tmp_path):
    """The messages have one form at every size, the values lie in the stored violations; rows are looked at twice."""
    contract = {"primary_key": ["id"], "quality_rules": {"not_null": ["id", "city"], "allowed": {"city": ["v1"], "other": ["x"]}}}
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for n in (3, 5000):
        rows = spark.range(n).selectExpr("id", "concat('v', id) as city", "'x' as other")
        summary = contracts.validate(rows.mapInArrow(look, rows.schema), contract)
        assert summary["errors"] == [f"Column 'city' has {n - 1} distinct disallowed values in {n - 1} rows"]
        assert summary["row_count"] == n
        listed = spark.read.parquet(summary["violations"]).filter("check_name = 'allowed_values'")
        assert listed.select("detail").distinct().count() == n - 1
        assert seen.value == 2 * n
        seen.value = 0
    assert contracts.validate(rows.limit(0), contract)["row_count"] == 0


def test_bad_trip_goes_to_quarantine(spark):
    rows = canonical(spark, [BAD_TRIP, "not json", "[1, 2]", trip(1, "ride_requested", 0)])
    assert quarantined_rows(rows).count() == 3
    assert valid_rows(rows).count() == 1


def test_unusable_copy_does_not_displace_a_usable_one(spark):
    broken = trip(1, "trip_completed", 5, 10.0)
    broken["city_id"] = None
    rows = staged(spark, [trip(1, "trip_completed", 5, 10.0), broken])
    assert rows.count() == 1


def test_payload_text_that_is_no_number_is_null(spark):
    row = canonical(
        spark, [trip(1, "x", 0, fare_total="abc", requested_trips="12.7", completed_trips=7, latitude="")]
    ).first()
    assert (row["fare_total"], row["requested_trips"], row["completed_trips"], row["latitude"]) == (
        None, None, 7, None,
    )


@pytest.mark.parametrize(
    "fields, amount",
    [
        ({"payment_amount": 5, "amount": 7}, 5.0),
        ({"payment_amount": 0, "amount": 7}, 7.0),
        ({"payment_amount": "", "amount": 7}, 7.0),
        ({"amount": 7}, 7.0),
        ({"payment_amount": "abc", "amount": 7}, None),
    ],
)
def test_either_key_may_hold_the_payment(spark, fields, amount):
    assert canonical(spark, [trip(1, "payment_captured", 0, **fields)]).first()["payment_amount"] == amount


def test_quarantine_and_valid_cover_the_input(spark):
    payloads = [trip(i, "x", i % 60) for i in range(20)] + [{"event_id": "a"}, {"city_id": "b"}, {}]
    rows = canonical(spark, payloads)
    assert valid_rows(rows).count() + quarantined_rows(rows).count() == len(payloads)


def test_zero_counts_as_missing_in_the_store(staging):
    rows = staging(
        {"event_id": "a", "event_type": "fraud_detected", "fraud_score": 0.0, "fare_total": 0.0,
         "surge_multiplier": 0.0, "event_time": "2026-06-16T10:00:00", "city_id": "NYC"}
    )
    case = store.fraud_cases(rows).first()
    assert (case["fraud_score"], case["final_fare"], case["surge_multiplier"]) == (None, None, 1.0)


def test_ticket_without_a_trip_says_none(staging):
    rows = staging(
        {"event_id": "a", "event_type": "complaint_raised", "event_time": "2026-06-16T10:00:00", "city_id": "NYC"}
    )
    text = store.support_tickets(rows).first()["description"]
    assert text == "Auto-synced from Silver: complaint_raised for trip None"


def test_completion_rate_guards_against_no_requests(staging):
    at = {"event_time": "2026-06-16T10:00:00", "city_id": "NYC", "rider_id": "r"}
    rows = staging({"event_id": "a", "event_type": "trip_completed", **at}, {"event_id": "b", "event_type": "trip_completed", **at})
    session = store.rider_sessions(rows).first()
    assert (session["completion_rate"], session["session_id"]) == (2.0, "session_r_NYC")


def test_documents_keep_their_fields(staging):
    rows = staging({"event_id": "a", "event_type": "complaint_raised", "event_time": "2026-06-16T10:00:00", "city_id": "NYC"})
    doc = store.as_documents(store.support_tickets(rows), "support_ticket_id")
    assert doc.select(F.get_json_object("document", "$.status")).first()[0] == "open"
