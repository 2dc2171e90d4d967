"""Adapters from the test tables to the inputs the jobs expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tripflow import schemas
from tripflow.settings import CANCELLED, COMPLETED, REQUESTED

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp"
    ),
    "events": (
        "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mapped(subject: Column, pairs: dict[str, str]) -> Column:
    result = None
    for source, target in pairs.items():
        hit = subject == source
        result = F.when(hit, target) if result is None else result.when(hit, target)
    return result


def _prefixed(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def canonical_events(events: DataFrame) -> DataFrame:
    """Canonical rows with planted NULLs and repeated ids; ``source_offset`` is arrival order."""
    n, u, value = F.col("n"), F.col("u"), F.col("value")
    purchase = F.col("kind") == "purchase"
    frame = events.select(
        F.col("event_id").alias("n"),
        F.col("user_id").alias("u"),
        F.col("event_type").alias("kind"),
        "ts",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    k = F.col("k")
    known_driver = F.col("kind") != "signup"
    columns = {
        "event_id": _prefixed("e", F.when(n % 50 == 49, n - 1).otherwise(n)),
        "event_type": _mapped(
            F.col("kind"),
            {
                "purchase": COMPLETED,
                "error": CANCELLED,
                "signup": REQUESTED,
                "view": "fraud_signal",
                "click": "support_ticket_created",
            },
        ),
        "event_time": F.col("ts"),
        "city_id": F.when(
            k != 99,
            F.element_at(
                F.array(F.lit("NYC"), F.lit("CHICAGO"), F.lit("DUBAI"), F.lit("ABU DHABI")),
                (u % 4).cast("int") + 1,
            ),
        ),
        "trip_id": _prefixed("t", n - n % 4),
        "rider_id": F.when(k != 98, _prefixed("r", u)),
        "driver_id": F.when(known_driver, _prefixed("d", u % 40)),
        "vehicle_id": F.when(known_driver, _prefixed("v", u % 40)),
        "payment_id": F.when(purchase, _prefixed("p", n)),
        "fraud_case_id": F.when(F.col("kind") == "view", _prefixed("f", n)),
        "support_ticket_id": F.when(F.col("kind") == "click", _prefixed("s", n)),
        "review_id": F.when(k % 7 == 0, _prefixed("w", n)),
        "rating_value": F.when(k % 7 == 0, (k % 5 + 1).cast("double")),
        "fare_total": F.when(purchase, value),
        "payment_amount": F.when(purchase, value),
        "platform_fee": F.when(purchase, value * 0.25),
        "driver_payout": F.when(purchase, value * 0.75),
        "surge_multiplier": 1 + (k % 10) / 10,
        "promotion_amount": F.when(k % 5 != 0, (k % 5).cast("double")),
        "fraud_score": F.when(F.col("kind") == "view", k / 100),
        "source_system": F.when(k % 11 != 0, _prefixed("src", k % 3)),
        "ingestion_time": F.col("ts"),
        "event_date": F.to_date("ts"),
    }
    declared = [
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.SILVER.fields
    ]
    return frame.select(*declared, n.alias("source_offset"))


# Topics the events are spread over.
EVENT_TOPICS = [
    "rh.trip.lifecycle.events.v1", "rh.fraud.signals.v1", "rh.support.tickets.v1",
]

# Payload key of each canonical column whose message uses another name.
_PAYLOAD_NAMES = {"payment_amount": "amount"}


def event_messages(events: DataFrame) -> DataFrame:
    """The same events as JSON messages; every fiftieth is delivered twice, unchanged."""
    canonical = canonical_events(events).withColumn(
        "event_id", _prefixed("e", F.col("source_offset"))
    )
    payload = [
        F.col(f.name).alias(_PAYLOAD_NAMES.get(f.name, f.name))
        for f in schemas.STAGING.fields
        if f.name not in ("event_time", "event_date")
    ]
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time")
    trips, fraud, support = EVENT_TOPICS
    topic = F.when(F.col("event_type") == "fraud_signal", fraud).when(
        F.col("event_type") == "support_ticket_created", support
    ).otherwise(trips)
    deliveries = F.when(
        F.col("source_offset") % 50 == 49, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    return canonical.select(
        F.col("event_id").alias("key"),
        F.to_json(F.struct(stamp, *payload)).alias("value"),
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        F.col("source_offset"),
        F.col("event_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.explode(deliveries).alias("delivery"),
    ).select(
        "key", "value", "topic", "partition",
        (F.col("source_offset") * 2 + F.col("delivery")).alias("offset"),
        "timestamp", "timestampType",
    )


def nyc_trips(lineitem: DataFrame) -> DataFrame:
    pickup = F.col("l_shipdate") + F.expr("INTERVAL 8 HOURS")
    return lineitem.select(
        F.col("l_linenumber").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        F.timestamp_micros(
            F.unix_micros(pickup) + (F.col("l_quantity") * 60_000_000).cast("bigint")
        ).alias("tpep_dropoff_datetime"),
        F.col("l_partkey").alias("PULocationID"),
        F.col("l_suppkey").alias("DOLocationID"),
        F.col("l_quantity").alias("trip_distance"),
        (F.col("l_extendedprice") / 1000).alias("total_amount"),
        F.col("l_returnflag").alias("payment_type"),
    )


def chicago_trips(orders: DataFrame) -> DataFrame:
    minutes = F.col("o_orderkey") % 60
    located = F.col("o_orderkey") % 4 != 0
    return orders.select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_custkey").alias("taxi_id"),
        F.col("o_orderdate").alias("trip_start_timestamp"),
        F.timestamp_micros(F.unix_micros("o_orderdate") + minutes * 60_000_000).alias(
            "trip_end_timestamp"
        ),
        (minutes * 60).alias("trip_seconds"),
        (F.col("o_orderkey") % 25).alias("trip_miles"),
        (F.col("o_custkey") % 77).alias("pickup_community_area"),
        F.when(located, 41.5 + (F.col("o_custkey") % 50) / 100).alias("pickup_centroid_latitude"),
        F.when(located, -87.9 + (F.col("o_custkey") % 40) / 100).alias("pickup_centroid_longitude"),
        F.when(located, 41.5 + (F.col("o_orderkey") % 50) / 100).alias("dropoff_centroid_latitude"),
        F.when(located, -87.9 + (F.col("o_orderkey") % 40) / 100).alias(
            "dropoff_centroid_longitude"
        ),
        (F.col("o_totalprice") / 10000).alias("fare"),
        F.when(F.col("o_orderkey") % 3 != 0, F.lit(1.5)).alias("tips"),
        F.lit(0.0).alias("tolls"),
        F.lit(0.5).alias("extras"),
        F.col("o_orderpriority").alias("payment_type"),
    )


def template_trips(orders: DataFrame) -> DataFrame:
    """Input of a city onboarded through the generic mapping."""
    return orders.select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_custkey").alias("driver_id"),
        F.col("o_orderdate").alias("pickup_ts"),
        (F.col("o_orderdate") + F.expr("INTERVAL 15 MINUTES")).alias("dropoff_ts"),
        (F.col("o_orderkey") % 30).cast("string").alias("distance_km"),
        F.lit("900").alias("duration_sec"),
        (F.col("o_totalprice") / 10000).alias("fare_total"),
        F.when(F.col("o_orderkey") % 2 == 0, "bad").otherwise("1.25").alias("surge_multiplier"),
        F.col("o_orderpriority").alias("payment_method_code"),
    )


def run_log(orders: DataFrame) -> DataFrame:
    """Start and finish entries of audited runs: one run per order, open orders still running."""
    key = F.col("o_orderkey")
    seconds = key % 3600 + 1
    started = F.struct(
        F.lit("running").alias("status"),
        F.col("o_orderdate").alias("at"),
        F.to_json(
            F.struct(
                F.lit("gold").alias("target_schema"),
                (key % 7).cast("string").alias("target_tables"),
            )
        ).alias("details"),
    )
    finished = F.struct(
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("status"),
        F.timestamp_micros(F.unix_micros("o_orderdate") + seconds * 1_000_000).alias("at"),
        F.to_json(
            F.struct(
                (key % 5).cast("string").alias("target_tables"),
                seconds.cast("string").alias("duration_seconds"),
            )
        ).alias("details"),
    )
    entries = F.when(F.col("o_orderstatus") == "P", F.array(started)).otherwise(
        F.array(started, finished)
    )
    return orders.select(
        _prefixed("run-", key).alias("run_id"),
        F.col("o_orderpriority").alias("pipeline_name"),
        _prefixed("stage-", F.col("o_custkey") % 5).alias("stage_name"),
        F.explode(entries).alias("entry"),
    ).select("run_id", "pipeline_name", "stage_name", "entry.*")


def request_log(events: DataFrame) -> DataFrame:
    """API requests: the event type is the endpoint, errors are server errors."""
    return events.select(
        F.col("ts"),
        F.concat(F.lit("/"), F.col("event_type")).alias("endpoint"),
        F.when(F.col("user_id") % 2 == 0, "GET").otherwise("POST").alias("method"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") / 100).alias("latency_seconds"),
    )


def corpus_documents(documents: DataFrame) -> DataFrame:
    from tripflow.sources.corpus import with_document_ids

    return with_document_ids(
        documents.select(
            F.lit("documents").alias("source_id"),
            F.lit("documents").alias("target_table"),
            F.col("source").alias("source_type"),
            F.col("lang").alias("city_id"),
            F.col("doc_id").cast("string").alias("doc_id"),
            "text",
        )
    )


def benchmark_questions(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def support_requests(conversations: DataFrame) -> DataFrame:
    """Tickets handed in by users, some with fields left out."""
    turn = F.col("turn")
    return conversations.select(
        F.concat_ws("-", F.lit("req"), F.col("conv_id"), turn).alias("support_ticket_id"),
        F.when(turn % 5 != 4, _prefixed("r", F.col("conv_id"))).alias("rider_id"),
        F.when(F.col("role") == "user", "NYC").otherwise("CHICAGO").alias("city_id"),
        F.col("role").alias("issue_type"),
        F.col("text").alias("description"),
        F.when(turn % 3 == 0, "closed").alias("status"),
        F.lit(None).cast("timestamp").alias("event_time"),
    )
