"""Run audit as an append-only log, folded to current state on read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType, StringType

from tripflow import schemas


def entry(
    spark: SparkSession, run_id: str, name: str, stage: str, status: str, at: datetime, details: str
) -> DataFrame:
    return spark.createDataFrame([(run_id, name, stage, status, at, details)], schemas.RUN_EVENT)


def current_runs(log: DataFrame) -> DataFrame:
    """State of each run. A start resets the run; the details of later entries are merged
    over the earlier ones, key by key. The log itself is only ever aggregated."""
    is_start = F.col("status") == "running"
    rank = F.struct(F.col("at"), (~is_start).alias("after_start"))
    finished = F.max(F.when(~is_start, F.col("at")))
    started = F.max(F.when(is_start, F.col("at")))
    latest = F.max_by(F.struct("pipeline_name", "stage_name", "status"), rank)
    state = log.groupBy("run_id").agg(
        latest.alias("latest"),
        started.alias("started_at"),
        F.when(started.isNull() | (finished >= started), finished).alias("ended_at"),
    ).select("run_id", "latest.*", "started_at", "ended_at")
    details = _merged_details(log, rank, state.select("run_id", "started_at"))
    return state.join(details, "run_id", "left").select(
        "run_id", "pipeline_name", "stage_name", "status", "started_at", "ended_at",
        F.coalesce("details", F.lit("{}")).alias("details"),
    )


def _merged_details(log: DataFrame, rank: Column, starts: DataFrame) -> DataFrame:
    """Latest value of every detail key set since the start, as JSON with sorted keys."""
    parsed = F.from_json("details", MapType(StringType(), StringType()))
    keyed = log.select("run_id", rank.alias("rank"), F.explode(parsed).alias("key", "value"))
    latest = keyed.groupBy("run_id", "key").agg(
        F.max_by("value", "rank").alias("value"), F.max("rank.at").alias("set_at")
    )
    current = latest.join(starts, "run_id").filter(
        F.col("started_at").isNull() | (F.col("set_at") >= F.col("started_at"))
    )
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    return current.groupBy("run_id").agg(
        F.to_json(F.map_from_entries(entries)).alias("details")
    )


def result_rollup(results: DataFrame) -> DataFrame:
    """Counts of build results per status and per resource type, from (status, unique_id)."""
    status = F.coalesce("status", F.lit("unknown"))
    dotted = F.col("unique_id").contains(".")
    resource = F.when(dotted, F.split("unique_id", "\\.").getItem(0)).otherwise("unknown")
    kinds = F.array(
        F.struct(F.lit("status").alias("kind"), status.alias("name")),
        F.struct(F.lit("resource").alias("kind"), resource.alias("name")),
    )
    return results.select(F.inline(kinds)).groupBy("kind", "name").agg(
        F.count(F.lit(1)).alias("results")
    )


def pipeline_health(runs: DataFrame) -> DataFrame:
    """Runs per pipeline and status, with the share that failed."""
    failed = F.avg(F.when(F.col("status") == "failed", 1.0).otherwise(0.0))
    seconds = F.get_json_object("details", "$.duration_seconds").try_cast("double")
    return runs.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("runs"),
        F.round(failed, 6).alias("failure_rate"),
        F.round(F.avg(seconds), 6).alias("avg_duration_s"),
    )
