"""One callable per operator or query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripflow import settings
from tripflow.functions import calendar
from tripflow.jobs import Warehouse
from tripflow.operators import (
    audit, contracts, dedup, embeddings, quality, retrieval, upsert, validity,
)
from tripflow.operators.skew import spread
from tripflow.plans import (
    checks, dimensions, facts, features, gold, models, monitoring, opendata, serving, silver, store,
)
from tripflow.session import configure, fresh_dir
from tripflow.sinks import report
from tripflow.sinks.incremental import DAY, IncrementalFact
from tripflow.sources import tables
from tripflow.sources.warehouse import all_messages, backfilled_layers, raw_events, staged_events, stream_layers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Stands for "now" wherever a result would otherwise depend on the clock.
NOW = datetime(2024, 1, 31)
TODAY = date(2024, 1, 30)
# End of the first load where a query shows a later one.
FIRST_LOAD_END = "2024-01-16 00:00:00"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.table(configure(spark), sf_dir, name)


def _wide(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows cost much CPU, over all cores even if it has few splits."""
    return spread(_table(spark, sf_dir, name))


def _mart(spark, sf_dir):
    return gold.city_daily_kpis(staged_events(spark, sf_dir))


def _fact(spark, sf_dir, name):
    return facts.fact(name, staged_events(spark, sf_dir))


# Bronze, silver, gold --------------------------------------------------------


@query
def bronze_messages(spark, sf_dir):
    bronze = silver.to_bronze(all_messages(spark, sf_dir))
    return bronze.select("topic", "partition", "offset", "kafka_timestamp", "key", "bronze_entity")


@query
def silver_canonical(spark, sf_dir):
    canonical = silver.to_canonical(silver.to_bronze(all_messages(spark, sf_dir)))
    return canonical.drop("ingestion_time", "raw_payload")


@query
def silver_quarantine(spark, sf_dir):
    rows = validity.quarantined_rows(raw_events(spark, sf_dir))
    return rows.select("event_id", "event_type", "event_time", "city_id", "trip_id", "rider_id")


@query
def loader_first_arrivals(spark, sf_dir):
    parsed = silver.with_payload(all_messages(spark, sf_dir), ["event_id"]).withColumn(
        "event_id", F.col("payload.event_id")
    )
    first = dedup.first_arrivals(parsed)
    return first.select("event_id", "topic", "offset")


@query
def loader_trip_payloads(spark, sf_dir):
    return silver.completed_trip_payloads(all_messages(spark, sf_dir)).groupBy("topic").agg(
        F.count(F.lit(1)).alias("payloads")
    )


@query
def staging_events(spark, sf_dir):
    return staged_events(spark, sf_dir)


@query
def duplicate_event_rows(spark, sf_dir):
    return dedup.repeated_row_count(raw_events(spark, sf_dir), ["event_id"])


@query
def duplicate_line_rows(spark, sf_dir):
    return dedup.repeated_row_count(
        _table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def gold_city_hourly(spark, sf_dir):
    return gold.city_hourly(staged_events(spark, sf_dir))


@query
def mart_city_daily_kpis(spark, sf_dir):
    return _mart(spark, sf_dir)


@query
def mart_completed_trips_only(spark, sf_dir):
    return gold.city_daily_kpis(staged_events(spark, sf_dir), completed_only=True)


# Dimensions and facts --------------------------------------------------------


@query
def dim_city(spark, sf_dir):
    return dimensions.dim_city(staged_events(spark, sf_dir))


@query
def dim_rider(spark, sf_dir):
    return dimensions.dim_rider(staged_events(spark, sf_dir), NOW)


@query
def dim_driver(spark, sf_dir):
    return dimensions.dim_driver(staged_events(spark, sf_dir), NOW)


@query
def dim_vehicle(spark, sf_dir):
    return dimensions.dim_vehicle(staged_events(spark, sf_dir))


@query
def dim_time(spark, sf_dir):
    return dimensions.dim_time(staged_events(spark, sf_dir))


@query
def dim_promotion(spark, sf_dir):
    return dimensions.dim_promotion(staged_events(spark, sf_dir))


@query
def dim_payment_method(spark, sf_dir):
    return dimensions.dim_payment_method(staged_events(spark, sf_dir))


@query
def dim_driver_history(spark, sf_dir):
    return dimensions.driver_history(staged_events(spark, sf_dir))


def _register_fact(name: str) -> None:
    def load(spark, sf_dir):
        return _fact(spark, sf_dir, name)

    def load_again(spark, sf_dir):
        staging = staged_events(spark, sf_dir)
        first = facts.fact(name, staging.filter(F.col("event_time") < FIRST_LOAD_END))
        incoming = facts.fact(name, staging, newer_than=upsert.high_water(first))
        return upsert.replace_by_key(first, incoming, [facts.FACTS[name].key])

    QUERIES[name] = load
    QUERIES[f"{name}_second_load"] = load_again


for _name in facts.FACTS:
    _register_fact(_name)


def _register_stored_fact(name: str) -> None:
    def load_twice(spark, sf_dir):
        """Two loads into the table on disk, the second of a staging that has grown."""
        staging = staged_events(spark, sf_dir)
        table = IncrementalFact(spark, name, fresh_dir(spark, "fact-loads"))
        table.load(staging.filter(F.col("event_time") < FIRST_LOAD_END))
        table.load(staging)
        return table.read().drop(DAY)

    QUERIES[f"{name}_stored_loads"] = load_twice


for _name in ("fact_trip", "fact_payment"):
    _register_stored_fact(_name)


@query
def fact_trip_latest_per_key(spark, sf_dir):
    return dedup.keep_last(
        _fact(spark, sf_dir, "fact_trip"), ["trip_fact_key"], ["created_at", "rider_key"]
    )


@query
def fact_trip_insert_if_absent(spark, sf_dir):
    trips = _fact(spark, sf_dir, "fact_trip")
    first = trips.filter(F.col("created_at") < FIRST_LOAD_END)
    return upsert.insert_if_absent(first, trips, ["trip_fact_key"])


@query
def fact_trip_replace_prefix(spark, sf_dir):
    trips = _fact(spark, sf_dir, "fact_trip")
    rebuilt = trips.filter(F.col("trip_id").startswith("t1")).withColumn(
        "promotion_amount", F.lit(0.0)
    )
    return upsert.replace_prefix(trips, rebuilt, "trip_id", "t1")


# City KPI queries ------------------------------------------------------------


@query
def serve_city_daily(spark, sf_dir):
    return serving.city_daily(_mart(spark, sf_dir), limit=30)


@query
def serve_kpi_table(spark, sf_dir):
    return serving.kpi_table(_mart(spark, sf_dir))


@query
def serve_completed_trips_series(spark, sf_dir):
    return serving.time_series(_mart(spark, sf_dir), "completed_trips")


@query
def serve_gross_fare_series(spark, sf_dir):
    return serving.time_series(_mart(spark, sf_dir), "gross_fare_total", rounded=True)


def _latest_day(spark, sf_dir, measure, name):
    staging = staged_events(spark, sf_dir)
    return serving.latest_day(gold.city_daily_kpis(staging), staging, measure, name)


@query
def serve_latest_surge(spark, sf_dir):
    return _latest_day(spark, sf_dir, "avg_surge_multiplier", "avg_surge")


@query
def serve_latest_driver_payout(spark, sf_dir):
    return _latest_day(spark, sf_dir, "driver_payout_total", "driver_payout")


@query
def serve_latest_platform_revenue(spark, sf_dir):
    return _latest_day(spark, sf_dir, "platform_fee_total", "platform_revenue")


@query
def serve_latest_trips(spark, sf_dir):
    return _latest_day(spark, sf_dir, "completed_trips", "trips")


# Fraud queries ---------------------------------------------------------------


@query
def serve_fraud_total(spark, sf_dir):
    return serving.fraud_count(_fact(spark, sf_dir, "fact_fraud"), "total_fraud_cases")


@query
def serve_fraud_high_risk(spark, sf_dir):
    return serving.fraud_count(
        _fact(spark, sf_dir, "fact_fraud"), "high_risk_cases", F.col("risk_band") == "high"
    )


@query
def serve_fraud_blocked(spark, sf_dir):
    return serving.fraud_count(
        _fact(spark, sf_dir, "fact_fraud"), "blocked_cases", F.col("blocked_flag")
    )


@query
def serve_fraud_average_score(spark, sf_dir):
    return serving.average_fraud_score(_fact(spark, sf_dir, "fact_fraud"))


@query
def serve_fraud_by_band_and_city(spark, sf_dir):
    staging = staged_events(spark, sf_dir)
    return serving.fraud_by_band_and_city(
        facts.fact("fact_fraud", staging), dimensions.dim_city(staging)
    )


@query
def serve_fraud_by_day(spark, sf_dir):
    return serving.fraud_by_day(_fact(spark, sf_dir, "fact_fraud"))


# Operational stores ----------------------------------------------------------


@query
def store_fraud_cases(spark, sf_dir):
    return store.fraud_cases(staged_events(spark, sf_dir), NOW)


@query
def store_support_tickets(spark, sf_dir):
    return store.support_tickets(staged_events(spark, sf_dir), NOW)


@query
def store_rider_sessions(spark, sf_dir):
    return store.rider_sessions(staged_events(spark, sf_dir), NOW)


@query
def store_totals(spark, sf_dir):
    staging = staged_events(spark, sf_dir)
    return store.store_totals(
        {
            "fraud_cases": store.fraud_cases(staging),
            "support_tickets": store.support_tickets(staging),
            "rider_app_sessions": store.rider_sessions(staging),
        }
    )


@query
def serve_fraud_cases(spark, sf_dir):
    cases = store.fraud_cases(staged_events(spark, sf_dir), NOW)
    return serving.newest(cases, "fraud_case_id", limit=50, city_id="NYC")


@query
def serve_support_tickets(spark, sf_dir):
    tickets = store.support_tickets(staged_events(spark, sf_dir), NOW)
    return serving.newest(
        tickets, "support_ticket_id", limit=500, city_id="CHICAGO", status="open"
    )


@query
def serve_rider_sessions(spark, sf_dir):
    sessions = store.rider_sessions(staged_events(spark, sf_dir), NOW)
    return serving.newest(sessions, "session_id", rider_id="r8")


@query
def ticket_intake_accepted(spark, sf_dir):
    requests = tables.support_requests(_table(spark, sf_dir, "conversations"))
    return store.accepted_tickets(requests, NOW)


@query
def ticket_intake_rejected(spark, sf_dir):
    requests = tables.support_requests(_table(spark, sf_dir, "conversations"))
    return store.rejected_tickets(requests).select("support_ticket_id", "missing_fields")


@query
def ticket_upsert(spark, sf_dir):
    staging = staged_events(spark, sf_dir)
    held = store.support_tickets(
        staging.filter(F.col("event_time") < FIRST_LOAD_END), datetime(2024, 1, 16)
    )
    changed = store.support_tickets(staging, NOW).select(
        "support_ticket_id", "city_id", "event_time",
        F.when(F.col("city_id") == "NYC", "closed").otherwise("open").alias("status"), "synced_at",
    )
    return upsert.merge_fields(held, changed, ["support_ticket_id"])


# Contracts -------------------------------------------------------------------


@query
def contract_violations_events(spark, sf_dir):
    return contracts.violations(raw_events(spark, sf_dir), settings.TRIP_CONTRACT)


@query
def contract_violations_open_trips(spark, sf_dir):
    trips = opendata.normalize(
        tables.template_trips(_wide(spark, sf_dir, "orders")),
        opendata.city_mapping("dubai", "dubai_open"),
        NOW,
    )
    return contracts.violations(trips, settings.TRIP_CONTRACT)


# Data quality ----------------------------------------------------------------


def _quality(spark, sf_dir, by_city=False):
    return quality.kpi_checks(_mart(spark, sf_dir), "dq", TODAY, NOW, 1, by_city)


@query
def quality_kpi_checks(spark, sf_dir):
    return _quality(spark, sf_dir)


@query
def quality_kpi_checks_by_city(spark, sf_dir):
    return _quality(spark, sf_dir, by_city=True)


@query
def quality_verdict(spark, sf_dir):
    return quality.verdict(_quality(spark, sf_dir, by_city=True))


@query
def quality_pass_rate(spark, sf_dir):
    return quality.pass_rate_by(
        _quality(spark, sf_dir, by_city=True), "run_id", settings.MIN_QUALITY_PASS_RATE
    )


@query
def quality_column_tests(spark, sf_dir):
    staging = staged_events(spark, sf_dir)
    built = {
        "silver_canonical_events": staging,
        "stg_silver_canonical_events": staging,
        "dim_city": dimensions.dim_city(staging),
        "dim_rider": dimensions.dim_rider(staging, NOW),
        "dim_driver": dimensions.dim_driver(staging, NOW),
        "dim_vehicle": dimensions.dim_vehicle(staging),
        "dim_promotion": dimensions.dim_promotion(staging),
        "dim_payment_method": dimensions.dim_payment_method(staging),
        "dim_time": dimensions.dim_time(staging),
        "mart_city_daily_kpis": gold.city_daily_kpis(staging),
        **{name: facts.fact(name, staging) for name in facts.FACTS},
    }
    result = None
    for name, frame in built.items():
        one = quality.column_tests(name, frame, quality.COLUMN_TESTS[name])
        result = one if result is None else result.unionByName(one)
    return result


@query
def serve_latest_quality(spark, sf_dir):
    return serving.latest_quality(_quality(spark, sf_dir, by_city=True), limit=200)


@query
def serve_recent_quality(spark, sf_dir):
    return serving.recent_quality_panel(_quality(spark, sf_dir, by_city=True))


# Run audit -------------------------------------------------------------------


def _runs(spark, sf_dir):
    return audit.current_runs(tables.run_log(_wide(spark, sf_dir, "orders")))


@query
def audit_current_runs(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    return runs.select(
        "run_id", "pipeline_name", "stage_name", "status", "started_at", "ended_at",
        F.get_json_object("details", "$.target_schema").alias("target_schema"),
        F.get_json_object("details", "$.target_tables").alias("target_tables"),
        F.get_json_object("details", "$.duration_seconds").alias("duration_seconds"),
    )


@query
def audit_run_health(spark, sf_dir):
    return audit.pipeline_health(_runs(spark, sf_dir))


@query
def audit_result_rollup(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "error").when(
        F.col("o_orderstatus") == "O", "success"
    )
    unique_id = F.when(
        F.col("o_orderkey") % 10 == 0, F.lit("plain")
    ).otherwise(F.concat(F.lower(F.substring("o_orderpriority", 3, 20)), F.lit(".x."), F.col("o_orderkey").cast("string")))
    return audit.result_rollup(orders.select(status.alias("status"), unique_id.alias("unique_id")))


@query
def serve_latest_runs(spark, sf_dir):
    return serving.latest_runs(_runs(spark, sf_dir), limit=100).drop("details")


@query
def serve_recent_runs(spark, sf_dir):
    return serving.recent_runs_panel(_runs(spark, sf_dir))


# Open data -------------------------------------------------------------------


@query
def open_trips_nyc(spark, sf_dir):
    return opendata.normalize(
        tables.nyc_trips(_wide(spark, sf_dir, "lineitem")), opendata.NYC, NOW
    )


@query
def open_trips_chicago(spark, sf_dir):
    return opendata.normalize(
        tables.chicago_trips(_wide(spark, sf_dir, "orders")), opendata.CHICAGO, NOW
    )


@query
def open_trips_new_city(spark, sf_dir):
    return opendata.normalize(
        tables.template_trips(_wide(spark, sf_dir, "orders")),
        opendata.city_mapping("dubai", "dubai_open"),
        NOW,
    )


@query
def open_trips_one_day(spark, sf_dir):
    source = tables.nyc_trips(_wide(spark, sf_dir, "lineitem"))
    day = calendar.parse_day("1998-05-05")
    return opendata.normalize(opendata.only_day(source, opendata.NYC, day), opendata.NYC, NOW)


def _enabled_sources(spark, sf_dir):
    sources = {
        "NYC": tables.nyc_trips(_wide(spark, sf_dir, "lineitem")),
        "CHICAGO": tables.chicago_trips(_wide(spark, sf_dir, "orders")),
    }
    return {city: sources[city] for city in opendata.enabled_cities()}


@query
def open_trips_all_cities(spark, sf_dir):
    trips = opendata.all_cities(_enabled_sources(spark, sf_dir), NOW)
    return trips.groupBy("city_id").agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(F.sum("fare_total"), 4).alias("fares"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


@query
def open_trips_append_keep_last(spark, sf_dir):
    source = tables.nyc_trips(_wide(spark, sf_dir, "lineitem"))
    held = opendata.normalize(source, opendata.NYC, datetime(2024, 1, 1))
    day = calendar.parse_day("1998-05-05")
    again = opendata.normalize(opendata.only_day(source, opendata.NYC, day), opendata.NYC, NOW)
    merged = upsert.append_keep_last(held, again, ["event_id"])
    return merged.select("event_id", "trip_id", "ingestion_time")


# Declared rules --------------------------------------------------------------


@query
def rules_alignment(spark, sf_dir):
    trips = opendata.all_cities(_enabled_sources(spark, sf_dir), NOW)
    return checks.alignment_rules(trips, opendata.enabled_cities())


@query
def rules_source_quality(spark, sf_dir):
    source = tables.nyc_trips(_wide(spark, sf_dir, "lineitem"))
    columns = {
        "start": "tpep_pickup_datetime", "end": "tpep_dropoff_datetime",
        "fare": "total_amount", "distance": "trip_distance",
    }
    return checks.source_rules(source, columns, [*columns.values(), "VendorID"])


@query
def kpi_extended_daily(spark, sf_dir):
    return checks.extended_daily_kpis(
        staged_events(spark, sf_dir), arrival="support_ticket_created"
    )


@query
def kpi_catalogue(spark, sf_dir):
    return checks.kpi_catalogue(staged_events(spark, sf_dir))


@query
def kpi_trailing_demand(spark, sf_dir):
    return gold.trailing_demand(_mart(spark, sf_dir))


@query
def rules_relationships(spark, sf_dir):
    staging = staged_events(spark, sf_dir)
    trips = facts.fact("fact_trip", staging)
    payments = facts.fact("fact_payment", staging)
    return checks.relationship_failures(
        [
            ("fact_trip", trips, "dim_city", dimensions.dim_city(staging), "city_key"),
            ("fact_trip", trips, "dim_rider", dimensions.dim_rider(staging, NOW), "rider_key"),
            ("fact_trip", trips, "dim_promotion", dimensions.dim_promotion(staging), "promotion_key"),
            ("fact_trip", trips, "dim_time", dimensions.dim_time(staging), "time_key"),
            (
                "fact_payment", payments, "dim_payment_method",
                dimensions.dim_payment_method(staging), "payment_method_key",
            ),
            (
                "fact_payment", payments, "completed_trip",
                trips.filter(F.col("completed_flag") == 1), "trip_id",
            ),
            (
                "fact_fraud", facts.fact("fact_fraud", staging), "completed_trip",
                trips.filter(F.col("completed_flag") == 1), "trip_id",
            ),
        ]
    )


# Order of the event types that the test events have in common with a trip.
EVENT_ORDER = ["ride_requested", "fraud_signal", "trip_completed", "support_ticket_created"]


@query
def rules_lifecycle(spark, sf_dir):
    return checks.lifecycle_breaks(staged_events(spark, sf_dir), EVENT_ORDER)


@query
def capacity_use(spark, sf_dir):
    tiers = {c["city_id"]: c["tier"] for c in settings.CITY_REGISTRY}
    return checks.capacity_use(staged_events(spark, sf_dir), tiers)


@query
def volume_anomalies(spark, sf_dir):
    return checks.volume_anomalies(staged_events(spark, sf_dir))


@query
def surge_out_of_bounds(spark, sf_dir):
    return checks.surge_out_of_bounds(staged_events(spark, sf_dir), 1.0, 1.75)


# Features and models ---------------------------------------------------------


@query
def feature_demand_city_daily(spark, sf_dir):
    return features.demand_city_daily(_mart(spark, sf_dir))


def _fraud_features(spark, sf_dir):
    staging = staged_events(spark, sf_dir)
    return features.fraud_trip(
        facts.fact("fact_fraud", staging), facts.fact("fact_trip", staging)
    )


def _churn(spark, sf_dir):
    return features.rider_churn_daily(_fact(spark, sf_dir, "fact_trip"))


@query
def feature_fraud_trip(spark, sf_dir):
    return _fraud_features(spark, sf_dir)


@query
def feature_rider_churn_daily(spark, sf_dir):
    return _churn(spark, sf_dir)


@query
def feature_rider_history(spark, sf_dir):
    return features.rider_history(staged_events(spark, sf_dir))


@query
def serve_churned_riders(spark, sf_dir):
    return serving.churned_riders(_churn(spark, sf_dir))


@query
def serve_active_riders(spark, sf_dir):
    return serving.active_riders(_churn(spark, sf_dir))


@query
def serve_churn_rate(spark, sf_dir):
    return serving.churn_rate(_churn(spark, sf_dir))


@query
def serve_active_and_churned(spark, sf_dir):
    return serving.active_and_churned(_churn(spark, sf_dir))


@query
def model_split(spark, sf_dir):
    spec = models.MODELS["churn_model"]
    churn = _churn(spark, sf_dir)
    return churn.groupBy(models.in_test_share(*spec.key).alias("is_test")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("churned_7d").alias("churned")
    )


_FEATURES = {
    "demand_model": lambda s, d: features.demand_city_daily(_mart(s, d)),
    "surge_model": lambda s, d: features.demand_city_daily(_mart(s, d)),
    "fraud_model": _fraud_features,
    "churn_model": _churn,
}


_OUTCOME = (
    "model_name string, status string, train_rows bigint, test_rows bigint, positive_rows bigint, metric_in_band boolean"
)


def _register_model(name: str) -> None:
    """Training and scoring, as far as they don't depend on the forest's random choices."""
    spec = models.MODELS[name]

    def train(spark, sf_dir):
        _, outcome = models.train(_FEATURES[name](spark, sf_dir), name)
        columns = [c.split()[0] for c in _OUTCOME.split(", ")]
        return spark.createDataFrame([tuple(outcome.get(c) for c in columns)], _OUTCOME)

    def score(spark, sf_dir):
        frame = _FEATURES[name](spark, sf_dir)
        model, outcome = models.train(frame, name, trees=20)
        if model is None:
            raise ValueError(f"{name}: {outcome['note']}")
        scored = models.score(model, frame, name)
        if spec.classifier:
            fits = F.col("prediction").isin(0, 1) & F.col("probability").between(0, 1)
        else:
            fits = (F.col("prediction") >= 0) & ~F.isnan("prediction")
        return scored.select(*spec.key, fits.alias("in_range"))

    QUERIES[f"train_{name}"] = train
    QUERIES[f"score_{name}"] = score


for _name in models.MODELS:
    _register_model(_name)


# Documents and retrieval -----------------------------------------------------


def _corpus(spark, sf_dir):
    return tables.corpus_documents(_wide(spark, sf_dir, "documents"))


@query
def corpus_documents(spark, sf_dir):
    return _corpus(spark, sf_dir).drop("text")


@query
def embedding_cells(spark, sf_dir):
    cells = embeddings.hashed_cells(_wide(spark, sf_dir, "documents"), "doc_id", "text")
    norms = cells.groupBy("doc_id").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight")).cast("double")).alias("norm")
    )
    return cells.join(norms, "doc_id").select(
        "doc_id", "idx", "weight", (F.col("weight") / F.col("norm")).alias("value")
    )


@query
def embedding_vectors(spark, sf_dir):
    supplied = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector")
    )
    documents = _wide(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = embeddings.document_vectors(documents, "doc_id", "text", supplied)
    return vectors.select(
        "doc_id",
        "provider",
        F.size("vector").alias("dim"),
        F.round(embeddings.norm(F.col("vector")), 5).alias("norm"),
    )


@query
def index_documents(spark, sf_dir):
    corpus = _corpus(spark, sf_dir)
    labelled = _table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("doc_id"))
    held = corpus.join(labelled, "doc_id", "left_semi").withColumn("source_id", F.lit("held"))
    index = upsert.insert_if_absent(held.select(*corpus.columns), corpus, ["id"])
    return index.select("id", "doc_id", "source_id", "city_id")


@query
def index_object_count(spark, sf_dir):
    return _corpus(spark, sf_dir).agg(F.count(F.lit(1)).alias("objects"))


def _hits(spark, sf_dir, k=5, city_id=None):
    corpus = retrieval.only_scope(_corpus(spark, sf_dir), city_id)
    questions = tables.benchmark_questions(_table(spark, sf_dir, "benchmark"))
    documents = embeddings.hash_vectors(corpus, "id", "text")
    asked = embeddings.hash_vectors(questions, "question_id", "question")
    hits = retrieval.nearest(documents, asked, "id", "question_id", k)
    return questions, retrieval.with_properties(hits, corpus, "id")


@query
def nearest_documents(spark, sf_dir):
    _, hits = _hits(spark, sf_dir)
    return hits.select("question_id", "rank", "id", "doc_id", "distance")


@query
def nearest_documents_in_scope(spark, sf_dir):
    _, hits = _hits(spark, sf_dir, k=3, city_id="en")
    return hits.select("question_id", "rank", "id", "city_id", "distance")


@query
def nearest_to_label_centre(spark, sf_dir):
    vectors = _table(spark, sf_dir, "embeddings")
    cells = vectors.select("label", F.posexplode("embedding").alias("pos", "v"))
    centre = cells.groupBy("label", "pos").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("v"))
    centres = centre.groupBy("label").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda c: c["v"]
        ).alias("vector")
    )
    documents = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return retrieval.nearest(documents, centres, "vec_id", "label", 10, dim=64)


@query
def answer_prompts(spark, sf_dir):
    questions, hits = _hits(spark, sf_dir)
    prompts = retrieval.prompts(questions, hits)
    return prompts.select("question_id", F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"))


@query
def answer_records(spark, sf_dir):
    questions, hits = _hits(spark, sf_dir)
    return retrieval.answers(questions, hits).select(
        "question_id", "answer", "used_fallback", "retrieved_count"
    )


# Monitoring ------------------------------------------------------------------


def _requests(spark, sf_dir):
    return tables.request_log(_wide(spark, sf_dir, "events"))


@query
def monitor_request_rate(spark, sf_dir):
    return monitoring.request_rate(_requests(spark, sf_dir))


@query
def monitor_error_ratio(spark, sf_dir):
    return monitoring.error_ratio(_requests(spark, sf_dir))


@query
def monitor_error_alerts(spark, sf_dir):
    return monitoring.held_alerts(monitoring.error_ratio(_requests(spark, sf_dir)), 5)


@query
def monitor_latency_p95(spark, sf_dir):
    return monitoring.latency_p95(_requests(spark, sf_dir))


@query
def monitor_latency_alerts(spark, sf_dir):
    windows = monitoring.latency_p95(_requests(spark, sf_dir), threshold=0.25)
    return monitoring.held_alerts(windows, 10)


# Inventory -------------------------------------------------------------------


@query
def table_inventory(spark, sf_dir):
    return report.row_counts(spark, {name: _table(spark, sf_dir, name) for name in tables.TABLES})


@query
def inventory_of_stored_tables(spark, sf_dir):
    """Counts of what jobs have written below one folder, by current version."""
    house = Warehouse(spark, fresh_dir(spark, "house"))
    staging = staged_events(spark, sf_dir)
    house.snapshot("staging").replace(staging, ["event_date", "city_id"])
    house.snapshot("dim_city").replace(dimensions.dim_city(staging))
    house.fact("fact_payment").load(staging)
    frames, paths = house.relations()
    return report.inventory(spark, frames, paths).drop("size_bytes")


# Names -----------------------------------------------------------------------


@query
def named_trips_by_city(spark, sf_dir):
    """Stored relations and the mart, a view, by name from SQL."""
    house = Warehouse(spark, fresh_dir(spark, "house"))
    staging = staged_events(spark, sf_dir)
    house.snapshot("staging").replace(staging, ["event_date", "city_id"])
    house.snapshot("dim_city").replace(dimensions.dim_city(staging))
    house.fact("fact_trip").load(staging)
    return house.sql(
        """select c.city_name, m.event_date, m.completed_trips, count(*) as trips, count(distinct f.trip_id) as trip_ids
           from {fact_trip} f join {dim_city} c on c.city_key = f.city_key
             join {mart_city_daily_kpis} m on m.city_id = c.city_id and m.event_date = to_date(f.created_at)
           group by c.city_name, m.event_date, m.completed_trips"""
    )


# Streams ---------------------------------------------------------------------


@query
def stream_bronze_messages(spark, sf_dir):
    layers = stream_layers(spark, sf_dir)
    return layers["bronze"].groupBy("topic", "bronze_entity").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@query
def stream_silver_events(spark, sf_dir):
    return stream_layers(spark, sf_dir)["silver"].drop("ingestion_time", "raw_payload")


@query
def stream_quarantine_events(spark, sf_dir):
    rows = stream_layers(spark, sf_dir)["quarantine"]
    return rows.select("event_id", "event_time", "city_id", "source_topic")


@query
def stream_gold_hourly(spark, sf_dir):
    return stream_layers(spark, sf_dir)["gold"]


@query
def backfill_events(spark, sf_dir):
    return backfilled_layers(spark, sf_dir)["silver"].drop("ingestion_time", "raw_payload")


@query
def backfill_gold_hourly(spark, sf_dir):
    return backfilled_layers(spark, sf_dir)["gold"]
