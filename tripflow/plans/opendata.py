"""Open trip records to canonical trips: one mapping, configured per city."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from tripflow import schemas
from tripflow.functions import calendar, coerce, keys
from tripflow.operators.contracts import gate
from tripflow.settings import CITY_REGISTRY, COMPLETED, KM_PER_MILE, PLATFORM_FEE_SHARE, TRIP_CONTRACT


class Fields:
    """Columns of a source frame, tolerant of ones it lacks."""

    def __init__(self, frame: DataFrame):
        self.names = set(frame.columns)

    def raw(self, name: str, default=None) -> Column:
        return F.col(name) if name in self.names else F.lit(default)

    def text(self, name: str, default: str | None = None) -> Column:
        return self.raw(name, default).cast("string")

    def number(self, name: str, default: float | None = None) -> Column:
        return coerce.to_double(self.raw(name, default))

    def number_or(self, name: str, default: float) -> Column:
        return F.coalesce(self.number(name, default), F.lit(default))

    def time(self, name: str) -> Column:
        return coerce.to_time(self.text(name))

    def time_text(self, name: str) -> Column:
        return F.date_format(self.time(name), "yyyy-MM-dd HH:mm:ss")


@dataclass(frozen=True)
class TripMapping:
    """How one source fills the canonical trip columns."""

    city_id: str
    source_system: str
    schema_version: str
    pickup: str
    dropoff: str
    columns: Callable[[Fields, "TripMapping"], dict[str, Column]]
    options: dict[str, str] = field(default_factory=dict)
    contract: dict | None = None


def _nyc(source: Fields, mapping: TripMapping) -> dict[str, Column]:
    vendor, pickup = source.text("VendorID"), source.time_text(mapping.pickup)
    zones = F.concat(source.text("PULocationID"), F.lit("_"), source.text("DOLocationID"))
    trip_id = F.concat(F.lit("nyc_"), vendor, F.lit("_"), pickup, F.lit("_"), zones)
    seconds = calendar.seconds_between(source.time(mapping.pickup), source.time(mapping.dropoff))
    return {
        "trip_id": trip_id,
        "rider_id": keys.sha256_of(F.lit("nyc_rider_"), zones, F.lit("_"), pickup),
        "driver_id": keys.sha256_of(F.lit("nyc_driver_"), vendor),
        "source_record_id": trip_id,
        "distance_km": source.number_or("trip_distance", 0.0) * KM_PER_MILE,
        "duration_sec": coerce.or_zero(seconds),
        "fare_total": source.number("total_amount", 0.0),
        "payment_method_code": source.text("payment_type", "unknown"),
    }


def _chicago(source: Fields, mapping: TripMapping) -> dict[str, Column]:
    trip_id = F.concat(F.lit("chi_"), source.text("trip_id"))
    fare = source.number_or("fare", 0.0)
    for extra in ("tips", "tolls", "extras"):
        fare = fare + source.number_or(extra, 0.0)
    # A missing area or start leaves its place in the hashed text empty.
    area = F.coalesce(source.text("pickup_community_area"), F.lit(""))
    start = F.coalesce(source.time_text(mapping.pickup), F.lit(""))
    return {
        "trip_id": trip_id,
        "rider_id": keys.sha256_of(F.lit("chi_rider_"), area, F.lit("_"), start),
        "driver_id": keys.sha256_of(
            F.lit("chi_driver_"), F.coalesce(source.text("taxi_id"), F.lit("unknown"))
        ),
        "source_record_id": source.text("trip_id"),
        "pickup_lat": source.number("pickup_centroid_latitude"),
        "pickup_lng": source.number("pickup_centroid_longitude"),
        "dropoff_lat": source.number("dropoff_centroid_latitude"),
        "dropoff_lng": source.number("dropoff_centroid_longitude"),
        "distance_km": source.number_or("trip_miles", 0.0) * KM_PER_MILE,
        "duration_sec": source.number_or("trip_seconds", 0.0),
        "fare_total": fare,
        "payment_method_code": source.text("payment_type", "unknown"),
    }


def _any_city(source: Fields, mapping: TripMapping) -> dict[str, Column]:
    record = source.text(mapping.options["trip_id_col"])
    driver = source.text(mapping.options["driver_id_col"])
    trip_id = F.concat(F.lit(f"{mapping.options['city'].lower()}_"), record)
    return {
        "trip_id": trip_id,
        "rider_id": keys.sha256_of(F.lit("rider_"), trip_id),
        "driver_id": keys.sha256_of(F.lit(f"driver_{mapping.options['city']}_"), driver),
        "source_record_id": record,
        **{c: source.number(c) for c in ("pickup_lat", "pickup_lng", "dropoff_lat", "dropoff_lng")},
        "distance_km": source.number_or("distance_km", 0.0),
        "duration_sec": source.number_or("duration_sec", 0.0),
        "fare_total": source.number_or("fare_total", 0.0),
        "surge_multiplier": source.number_or("surge_multiplier", 1.0),
        "promotion_amount": source.number_or("promotion_amount", 0.0),
        "payment_method_code": source.text("payment_method_code", "unknown"),
    }


NYC = TripMapping(
    "NYC", "nyc_tlc", "nyc_v1", "tpep_pickup_datetime", "tpep_dropoff_datetime", _nyc,
    contract=TRIP_CONTRACT,
)
CHICAGO = TripMapping(
    "CHICAGO", "chicago_taxi", "chicago_v1", "trip_start_timestamp", "trip_end_timestamp", _chicago,
    contract=TRIP_CONTRACT,
)
MAPPINGS = {m.city_id: m for m in (NYC, CHICAGO)}


def city_mapping(
    city_id: str,
    source_system: str,
    pickup_ts_col: str = "pickup_ts",
    dropoff_ts_col: str = "dropoff_ts",
    trip_id_col: str = "trip_id",
    driver_id_col: str = "driver_id",
) -> TripMapping:
    """Mapping for a newly onboarded city; it has no contract yet."""
    return TripMapping(
        city_id.upper(), source_system, "city_template_v1", pickup_ts_col, dropoff_ts_col,
        _any_city,
        {"city": city_id, "trip_id_col": trip_id_col, "driver_id_col": driver_id_col},
    )


def normalize(
    source: DataFrame, mapping: TripMapping, ingested_at: datetime | None = None
) -> DataFrame:
    """Canonical trips: a completed trip per record, fee a fixed share of the fare."""
    fields = Fields(source)
    own = mapping.columns(fields, mapping)
    now = F.lit(ingested_at) if ingested_at is not None else F.current_timestamp()
    fare = own["fare_total"]
    fee = fare * PLATFORM_FEE_SHARE
    shared = {
        "event_id": keys.sha256_of(F.lit("evt_"), own["trip_id"]),
        "city_id": F.lit(mapping.city_id),
        "event_type": F.lit(COMPLETED),
        "event_time": fields.time(mapping.dropoff),
        "pickup_ts": fields.time(mapping.pickup),
        "dropoff_ts": fields.time(mapping.dropoff),
        "ingestion_time": now,
        "surge_multiplier": F.lit(1.0),
        "promotion_amount": F.lit(0.0),
        "platform_fee": fee,
        "driver_payout": fare - fee,
        "source_system": F.lit(mapping.source_system),
        "schema_version": F.lit(mapping.schema_version),
    }
    filled = {**shared, **own}
    return source.select(
        *[
            filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.TRIP.fields
        ]
    )


def only_day(source: DataFrame, mapping: TripMapping, day: date) -> DataFrame:
    """Records picked up that day; a real timestamp column keeps the filter in the scan."""
    kind = dict(source.dtypes)[mapping.pickup]
    pickup = F.col(mapping.pickup)
    return source.filter(
        calendar.on_day(pickup if kind.startswith("timestamp") else coerce.to_time(pickup), day)
    )


def enabled_cities(registry: list[dict] = CITY_REGISTRY) -> list[str]:
    """Cities switched on whose source has a mapping; all mapped cities if none is."""
    known = {m.source_system: m.city_id for m in MAPPINGS.values()}
    chosen = [
        city["city_id"].upper()
        for city in registry
        if city.get("enabled") and known.get(city.get("open_data")) == city["city_id"].upper()
    ]
    return chosen or list(MAPPINGS)


def city_batch(
    source: DataFrame,
    city_id: str,
    for_date: str | None = None,
    mode: str = "enforce",
    ingested_at: datetime | None = None,
) -> DataFrame:
    """One city's canonical trips, past the contract."""
    if city_id.upper() not in MAPPINGS:
        raise ValueError(f"no open-data mapping for city {city_id!r}; known: {sorted(MAPPINGS)}")
    mapping = MAPPINGS[city_id.upper()]
    if for_date is not None:
        source = only_day(source, mapping, calendar.parse_day(for_date))
    trips = normalize(source, mapping, ingested_at)
    if mapping.contract:
        gate(trips, mapping.contract, mode)
    return trips


def all_cities(sources: dict[str, DataFrame], ingested_at: datetime | None = None) -> DataFrame:
    trips = None
    for city_id, source in sources.items():
        one = normalize(source, MAPPINGS[city_id.upper()], ingested_at)
        trips = one if trips is None else trips.unionByName(one)
    return trips
