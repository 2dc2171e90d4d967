"""Keyed merges built from an anti join and a union."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

EPOCH = datetime(1970, 1, 1)


def high_water(table: DataFrame, column: str = "created_at", lookback: timedelta = timedelta(0)):
    """Latest value of the column, less the lookback; the epoch for an empty table."""
    latest = table.agg(F.max(column)).first()[0]
    return latest - lookback if latest is not None else EPOCH


def untouched(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows no incoming key replaces; the incoming side shrinks to distinct keys."""
    return existing.join(incoming.select(*key).distinct(), key, "left_anti")


def replace_by_key(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Incoming rows win. Repeats of a key inside the incoming rows all stay."""
    kept = untouched(existing, incoming, key).select(*existing.columns)
    return kept.unionByName(incoming, allowMissingColumns=True)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows win."""
    fresh = incoming.join(existing.select(*key).distinct(), key, "left_anti")
    return existing.unionByName(fresh.select(*incoming.columns), allowMissingColumns=True)


def merge_fields(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Set the fields the incoming documents carry; keep the others of the old document.

    The incoming side must hold one document per key.
    """
    carried = [c for c in incoming.columns if c not in key]
    rest = [c for c in existing.columns if c not in key and c not in carried]
    both = existing.select(*key, *rest).join(incoming, key, "right")
    changed = both.select(*key, *carried, *rest)
    return untouched(existing, incoming, key).unionByName(changed, allowMissingColumns=True)


def replace_prefix(existing: DataFrame, incoming: DataFrame, column: str, prefix: str) -> DataFrame:
    """Delete the rows whose column starts with the prefix, then insert."""
    starts = F.coalesce(F.col(column).startswith(prefix), F.lit(False))
    return existing.filter(~starts).unionByName(incoming)


def append_keep_last(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Row concatenation, then the last copy of each key: incoming before existing.

    Repeats of a key inside one side are settled by ``ingestion_time`` and then
    by the whole row, so that the outcome does not depend on file order.
    """
    from tripflow.operators.dedup import keep_last

    stacked = existing.withColumn("_side", F.lit(0)).unionByName(
        incoming.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    tie = F.xxhash64(*[F.col(c) for c in incoming.columns])
    ranked = stacked.withColumn("_tie", tie)
    order = ["_side"] + (["ingestion_time"] if "ingestion_time" in incoming.columns else [])
    return keep_last(ranked, key, order + ["_tie"]).drop("_side", "_tie")
