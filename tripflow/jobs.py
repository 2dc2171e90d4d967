"""Jobs for spark-submit: ``spark-submit tripflow/jobs.py <job> [options]``.

Every job reads and writes folders; ``--warehouse`` is the folder that holds the
models. Jobs leave entries in the run log next to the models.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time
import uuid
from datetime import datetime, timedelta, timezone
from string import Formatter

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripflow import schemas, settings
from tripflow.operators import audit, embeddings, quality, retrieval
from tripflow.operators.conform import to_staging
from tripflow.plans import dimensions, facts, features, gold, models, opendata, store
from tripflow.session import build_session
from tripflow.sinks.backfill import backfill_gold, backfill_silver, history_days
from tripflow.sinks.buckets import BucketedTable
from tripflow.sinks.incremental import IncrementalFact
from tripflow.sinks.report import inventory, readable, write_csv
from tripflow.sinks.snapshots import SnapshotTable, folder_exists
from tripflow.sources.corpus import with_document_ids
from tripflow.sources.lake import read_layer, read_query, read_silver, read_source_file
from tripflow.streaming import bronze, gold as gold_stream, silver
from tripflow.streaming.run import ProgressLog, await_all

DIMENSIONS = {
    "dim_city": dimensions.dim_city,
    "dim_rider": dimensions.dim_rider,
    "dim_driver": dimensions.dim_driver,
    "dim_vehicle": dimensions.dim_vehicle,
    "dim_time": dimensions.dim_time,
    "dim_promotion": dimensions.dim_promotion,
    "dim_payment_method": dimensions.dim_payment_method,
}
MART = "mart_city_daily_kpis"
STORES = {
    "fraud_cases": (store.fraud_cases, "fraud_case_id"),
    "support_tickets": (store.support_tickets, "support_ticket_id"),
    "rider_app_sessions": (store.rider_sessions, "session_id"),
}

# Tables that are merged by key, and their keys.
KEYED = {f"store_{name}": key for name, (_, key) in STORES.items()} | {"document_index": "id"}


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Warehouse:
    """Models below one folder, by name."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def snapshot(self, name: str) -> SnapshotTable:
        schema = schemas.STAGING if name == "staging" else None
        return SnapshotTable(self.spark, f"{self.root}/{name}", schema)

    def fact(self, name: str) -> IncrementalFact:
        return IncrementalFact(self.spark, name, f"{self.root}/facts")

    def keyed(self, name: str) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.root}/{name}", [KEYED[name]])

    def read(self, name: str) -> DataFrame:
        if name in KEYED:
            return self.keyed(name).read()
        return self.fact(name).read() if name in facts.FACTS else self.snapshot(name).read()

    def relations(self) -> tuple[dict[str, DataFrame | None], dict[str, str]]:
        """What has been written, by name: frames, None where one can't be read, and the folders of the
        current content of those that can."""
        snapshots = [
            "staging", *DIMENSIONS, *dict.fromkeys(FEATURES_OF.values()),
            *(f"scores_{name}" for name in models.MODELS),
        ]
        paths = {n: self.snapshot(n).path for n in snapshots if self.snapshot(n).exists()}
        paths |= {n: self.keyed(n).path for n in KEYED if self.keyed(n).exists()}
        paths |= {n: self.fact(n).path for n in facts.FACTS if self.fact(n).loaded()}
        frames = {name: readable(lambda name=name: self.read(name)) for name in paths}
        for name, schema in (("run_log", schemas.RUN_EVENT), ("quality_log", schemas.QUALITY_RESULT)):
            path = f"{self.root}/{name}"
            if folder_exists(self.spark, path):
                frames[name], paths[name] = self.spark.read.schema(schema).parquet(path), path
        return frames, {name: path for name, path in paths.items() if frames[name] is not None}

    def mart(self) -> DataFrame:
        """A view: computed from staging whenever it is read."""
        return gold.city_daily_kpis(self.read("staging"))

    def sql(self, query: str) -> DataFrame:
        """SQL over the current versions, written ``{name}``: what a job wrote, or the mart."""
        names = {name for _, name, _, _ in Formatter().parse(query) if name}
        return read_query(self.spark, query, {n: self.mart() if n == MART else self.read(n) for n in names})

    def log(self, run_id: str, job: str, status: str, details: dict) -> None:
        line = audit.entry(
            self.spark, run_id, job, job.split("-")[0], status, _utc_now(), json.dumps(details)
        )
        line.write.mode("append").parquet(f"{self.root}/run_log")


def run_bronze(spark, args) -> dict:
    queries = bronze.start_all(
        spark, args.bronze_root, args.checkpoint_root, args.bounded, files=args.files,
        kafka=_kafka(args), max_files=args.max_files,
    )
    await_all(queries)
    return {"topics": len(queries)}


def _kafka(args) -> dict:
    return {
        "bootstrap_servers": args.bootstrap_servers,
        "starting_offsets": args.starting_offsets,
        "fail_on_data_loss": args.fail_on_data_loss,
    }


def _followed(spark, args, queries) -> dict:
    """Wait for the end and tell how many rows came too late, over all runs of these queries."""
    log = ProgressLog(spark, f"{args.checkpoint_root}/progress")
    await_all(queries, log)
    names = [q.name for q in queries]
    late = log.late_rows().filter(F.col("name").isin(names)).collect()
    return {f"late_rows_{r['name']}": r["late_rows"] for r in late}


def run_silver(spark, args) -> dict:
    queries = silver.start(
        spark, args.bronze_root, args.silver_root, args.checkpoint_root, args.bounded,
        args.watermark, args.max_files, state_partitions=args.state_partitions,
    )
    return _followed(spark, args, queries)


def run_gold(spark, args) -> dict:
    query = gold_stream.start(
        spark, args.silver_root, args.gold_root, args.checkpoint_root, args.bounded, args.max_files,
        args.state_partitions,
    )
    return _followed(spark, args, [query])


def run_open_data(spark, args) -> dict:
    source = read_source_file(spark, args.input)
    if args.city_id.upper() in opendata.MAPPINGS:
        trips = opendata.city_batch(source, args.city_id, args.for_date, args.contract_mode)
    else:
        mapping = opendata.city_mapping(args.city_id, args.source_system)
        if args.for_date:
            day = opendata.calendar.parse_day(args.for_date)
            source = opendata.only_day(source, mapping, day)
        trips = opendata.normalize(source, mapping)
    table = SnapshotTable(spark, args.output)
    if args.append:
        table.append_keep_last(trips, ["event_id"])
    else:
        table.replace(trips)
    return {"city_id": args.city_id, "for_date": args.for_date}


def run_staging(spark, args) -> dict:
    canonical = read_silver(spark, args.silver_root)
    # All rows of a micro-batch have one ingestion time; a hash of the row settles the rest.
    marked = canonical.withColumn("_copy", F.xxhash64(*canonical.columns))
    staged = to_staging(marked, ["ingestion_time", "_copy"])
    Warehouse(spark, args.warehouse).snapshot("staging").replace(
        staged.hint("rebalance", "event_date", "city_id"), ["event_date", "city_id"]
    )
    return {}


def run_backfill(spark, args) -> dict:
    history = read_layer(spark, args.input, schemas.STAGING)
    added = backfill_silver(spark, history, args.silver_root)
    if args.gold_root:
        backfill_gold(spark, history_days(history), args.silver_root, args.gold_root, args.watermark)
    return {"backfilled": added}


def run_models(spark, args) -> dict:
    warehouse = Warehouse(spark, args.warehouse)
    staging = warehouse.read("staging")
    for name, build in DIMENSIONS.items():
        warehouse.snapshot(name).replace(build(staging))
    marks = {
        name: str(warehouse.fact(name).load(staging, timedelta(hours=args.lookback_hours)))
        for name in facts.FACTS
    }
    return {"dimensions": len(DIMENSIONS), "high_water": marks}


def run_features(spark, args) -> dict:
    warehouse = Warehouse(spark, args.warehouse)
    trips, fraud = warehouse.read("fact_trip"), warehouse.read("fact_fraud")
    built = {
        "feature_demand_city_daily": features.demand_city_daily(warehouse.mart()),
        "feature_fraud_trip": features.fraud_trip(fraud, trips),
        "feature_rider_churn_daily": features.rider_churn_daily(trips),
    }
    for name, frame in built.items():
        warehouse.snapshot(name).replace(frame)
    return {"target_tables": len(built)}


FEATURES_OF = {
    "demand_model": "feature_demand_city_daily",
    "surge_model": "feature_demand_city_daily",
    "fraud_model": "feature_fraud_trip",
    "churn_model": "feature_rider_churn_daily",
}


def run_train(spark, args) -> dict:
    warehouse = Warehouse(spark, args.warehouse)
    outcomes = {}
    for name in args.models or list(models.MODELS):
        model, outcome = models.train(warehouse.read(FEATURES_OF[name]), name)
        if model is not None:
            models.save(model, f"{args.artifacts}/{name}")
        outcomes[name] = outcome
    return outcomes


def run_score(spark, args) -> dict:
    warehouse = Warehouse(spark, args.warehouse)
    for name in args.models or list(models.MODELS):
        scored = models.score(
            models.load(f"{args.artifacts}/{name}"), warehouse.read(FEATURES_OF[name]), name
        )
        warehouse.snapshot(f"scores_{name}").replace(scored)
    return {}


def run_stores(spark, args) -> dict:
    warehouse = Warehouse(spark, args.warehouse)
    staging = warehouse.read("staging")
    for name, (build, _) in STORES.items():
        warehouse.keyed(f"store_{name}").set_fields(build(staging))
    return {"collections": len(STORES)}


def run_quality(spark, args) -> dict:
    warehouse = Warehouse(spark, args.warehouse)
    now, run_id = _utc_now(), f"dq-{uuid.uuid4()}"
    results = quality.kpi_checks(warehouse.mart(), run_id, now.date(), now, args.max_age_days)
    path = f"{warehouse.root}/quality_log"
    results.write.mode("append").parquet(path)
    written = spark.read.schema(schemas.QUALITY_RESULT).parquet(path)
    quality.require_pass(written.filter(written["run_id"] == run_id))
    return {"quality_run_id": run_id}


def run_index(spark, args) -> dict:
    corpus = with_document_ids(read_layer(spark, args.input, schemas.CORPUS))
    index = Warehouse(spark, args.warehouse).keyed("document_index")
    if index.exists():
        # Only new documents are hashed.
        corpus = corpus.join(index.read().select("id"), "id", "left_anti")
    vectors = embeddings.hash_vectors(corpus, "id", "text")
    index.insert_absent(corpus.join(vectors, "id"))
    return {"indexed_docs_total": index.read().count()}


def run_ask(spark, args) -> dict:
    """Questions from a JSON-lines folder with ``question_id`` and ``question``."""
    warehouse = Warehouse(spark, args.warehouse)
    questions = spark.read.schema("question_id string, question string").json(args.input)
    index = retrieval.only_scope(warehouse.read("document_index"), args.city_id)
    asked = embeddings.hash_vectors(questions, "question_id", "question")
    hits = retrieval.nearest(index.select("id", "vector"), asked, "id", "question_id", args.top_k)
    full = retrieval.with_properties(hits, index.drop("vector"), "id")
    retrieval.answers(questions, full).write.mode("overwrite").json(args.output)
    return {"top_k": args.top_k}


def run_inventory(spark, args) -> dict:
    warehouse = Warehouse(spark, args.warehouse)
    frames, paths = warehouse.relations()
    write_csv(inventory(spark, frames, paths), args.output)
    return {"relations": len(frames)}


def run_query(spark, args) -> dict:
    Warehouse(spark, args.warehouse).sql(args.sql).write.mode("overwrite").parquet(args.output)
    return {}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, run, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        sub.set_defaults(run=run)
        return sub

    def stream(name: str, run, *options: str) -> argparse.ArgumentParser:
        sub = job(name, run, *options, "checkpoint-root")
        sub.add_argument("--bounded", action="store_true", help="work off what is there, then stop")
        sub.add_argument("--max-files", type=int, help="files per micro-batch")
        if name != "bronze":
            sub.add_argument(
                "--state-partitions", type=int,
                help="width of the state, for life; by default the cores registered at the first start",
            )
        return sub

    one = stream("bronze", run_bronze, "bronze-root")
    one.add_argument("--files", help="folder of file-based topics, instead of Kafka")
    one.add_argument("--bootstrap-servers", default="kafka:9092")
    one.add_argument("--starting-offsets", default="earliest")
    one.add_argument("--fail-on-data-loss", action="store_true")
    one = stream("silver", run_silver, "bronze-root", "silver-root")
    one.add_argument("--watermark", default=settings.WATERMARK)
    stream("gold", run_gold, "silver-root", "gold-root")
    one = job("open-data", run_open_data, "city-id", "input", "output")
    one.add_argument("--source-system", default="open")
    one.add_argument("--for-date", help="YYYY-MM-DD or today")
    one.add_argument("--append", action="store_true", help="keep earlier trips, last copy wins")
    one.add_argument("--contract-mode", choices=["enforce", "warn"], default="enforce")
    one = job("staging", run_staging, "silver-root", "warehouse")
    one = job("backfill", run_backfill, "input", "silver-root")
    one.add_argument("--gold-root", help="write the hours the history touches again, beside the streamed ones")
    one.add_argument("--watermark", default=settings.WATERMARK)
    one = job("models", run_models, "warehouse")
    one.add_argument("--lookback-hours", type=float, default=0.0)
    job("features", run_features, "warehouse")
    for name, run in (("train", run_train), ("score", run_score)):
        job(name, run, "warehouse", "artifacts").add_argument("--models", nargs="*")
    job("stores", run_stores, "warehouse")
    job("quality", run_quality, "warehouse").add_argument("--max-age-days", type=int, default=1)
    job("index", run_index, "warehouse", "input")
    one = job("ask", run_ask, "warehouse", "input", "output")
    one.add_argument("--top-k", type=int, default=settings.DEFAULT_TOP_K)
    one.add_argument("--city-id")
    job("inventory", run_inventory, "warehouse", "output")
    job("query", run_query, "warehouse", "sql", "output")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or build_session(f"tripflow-{args.job}")
    root = getattr(args, "warehouse", None)
    run_id, started = f"{args.job}-{uuid.uuid4()}", time.perf_counter()
    if root:
        Warehouse(spark, root).log(run_id, args.job, "running", {})

    def finish(status: str, details: dict) -> None:
        details["duration_seconds"] = round(time.perf_counter() - started, 3)
        if root:
            Warehouse(spark, root).log(run_id, args.job, status, details)
        print(json.dumps({"run_id": run_id, "status": status, **details}, default=str))

    try:
        details = args.run(spark, args)
    except Exception as error:
        finish("failed", {"error": str(error)})
        raise
    finish("success", details)


if __name__ == "__main__":
    main()
