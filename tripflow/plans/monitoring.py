"""Request rate, error ratio and latency over sliding windows of a request log.

Requests shrink to a row per series and minute first. The sliding windows are
sums of minutes, so each row that fans out stands for a whole minute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tripflow.functions.measures import count_where
from tripflow.settings import LATENCY_BUCKETS, MAX_ERROR_RATIO, MAX_P95_SECONDS


def _window_ends(minutes: int) -> Column:
    """Ends of the windows a minute belongs to: one per minute that follows."""
    minute = F.expr("INTERVAL 1 MINUTE")
    first = F.col("minute") + minute
    last = F.col("minute") + F.expr(f"INTERVAL {minutes} MINUTES")
    return F.explode(F.sequence(first, last, minute))


def _per_minute(requests: DataFrame, series: list[str], measures: list[Column]) -> DataFrame:
    return requests.groupBy(*series, F.date_trunc("minute", "ts").alias("minute")).agg(*measures)


def request_rate(requests: DataFrame, minutes: int = 5) -> DataFrame:
    """Requests per second for each method and endpoint."""
    series = ["method", "endpoint"]
    counts = _per_minute(requests, series, [F.count(F.lit(1)).alias("_n")])
    spread = counts.select(*series, "_n", _window_ends(minutes).alias("window_end"))
    return spread.groupBy(*series, "window_end").agg(
        F.sum("_n").alias("requests"),
        F.round(F.sum("_n") / F.lit(60.0 * minutes), 6).alias("requests_per_second"),
    )


def error_ratio(
    requests: DataFrame, minutes: int = 5, threshold: float = MAX_ERROR_RATIO, floor: float = 0.001
) -> DataFrame:
    """Share of server errors in each window; the request rate in the denominator has a floor."""
    failed = count_where(F.col("status").between(500, 599))
    counts = _per_minute(
        requests, [], [F.count(F.lit(1)).alias("_n"), failed.alias("_errors")]
    )
    spread = counts.select("_n", "_errors", _window_ends(minutes).alias("window_end"))
    seconds = F.lit(60.0 * minutes)
    rate = (F.sum("_errors") / seconds) / F.greatest(F.sum("_n") / seconds, F.lit(floor))
    return spread.groupBy("window_end").agg(
        F.sum("_n").alias("requests"),
        F.sum("_errors").alias("errors"),
        F.round(rate, 6).alias("error_ratio"),
    ).withColumn("above", F.col("error_ratio") > threshold)


def held_alerts(windows: DataFrame, hold_minutes: int = 5) -> DataFrame:
    """Window ends at which the condition held at this and the ``hold_minutes`` ends before.

    Each end that is above counts for the following ends; a count of all of
    them means the condition never dropped.
    """
    span = hold_minutes + 1
    minute = F.expr("INTERVAL 1 MINUTE")
    last = F.col("window_end") + F.expr(f"INTERVAL {hold_minutes} MINUTES")
    votes = windows.filter(F.col("above")).select(
        F.explode(F.sequence(F.col("window_end"), last, minute)).alias("fires_at")
    )
    return (
        votes.groupBy("fires_at")
        .agg(F.count(F.lit(1)).alias("_held"))
        .filter(F.col("_held") == span)
        .select("fires_at")
    )


def latency_p95(
    requests: DataFrame,
    minutes: int = 5,
    quantile: float = 0.95,
    threshold: float = MAX_P95_SECONDS,
    bounds: list[float] = LATENCY_BUCKETS,
) -> DataFrame:
    """Latency quantile from cumulative histogram buckets, linear inside a bucket.

    Buckets add up over tasks and minutes, unlike quantiles. A quantile that
    falls beyond the last finite bound is reported as that bound.
    """
    latency = F.col("latency_seconds")
    buckets = [count_where(latency <= bound).alias(f"_le{i}") for i, bound in enumerate(bounds)]
    counts = _per_minute(requests, [], [F.count(F.lit(1)).alias("_all"), *buckets])
    names = [f"_le{i}" for i in range(len(bounds))]
    spread = counts.select("_all", *names, _window_ends(minutes).alias("window_end"))
    totals = spread.groupBy("window_end").agg(
        F.sum("_all").alias("requests"), *[F.sum(n).alias(n) for n in names]
    )
    rank = F.col("requests") * F.lit(quantile)
    value = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        lower = float(bounds[i - 1]) if i else 0.0
        below = F.col(names[i - 1]) if i else F.lit(0)
        inside = F.col(names[i]) - below
        share = (rank - below) / F.when(inside != 0, inside)
        value = F.when(
            F.col(names[i]) >= rank, F.lit(lower) + (F.lit(float(bounds[i])) - lower) * share
        ).otherwise(value)
    return totals.select(
        "window_end", "requests", F.round(value, 6).alias("p95_seconds")
    ).withColumn("above", F.col("p95_seconds") > threshold)
