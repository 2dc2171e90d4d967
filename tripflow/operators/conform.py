"""Bring frames to a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tripflow import schemas
from tripflow.functions import coerce
from tripflow.operators.dedup import keep_last
from tripflow.operators.validity import valid_rows


def conform(frame: DataFrame, target: T.StructType) -> DataFrame:
    """Declared columns in declared order: missing ones NULL, unusable text NULL."""
    present = set(frame.columns)
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    columns = []
    for field in target.fields:
        if field.name not in present:
            value = F.lit(None).cast(field.dataType)
        elif kinds[field.name] == field.dataType:
            value = F.col(field.name)
        elif isinstance(kinds[field.name], T.StringType):
            value = _from_text(field)
        else:
            value = F.col(field.name).try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return frame.select(*columns)


def _from_text(field: T.StructField):
    value = F.col(field.name)
    if isinstance(field.dataType, T.DoubleType):
        return coerce.to_double(value)
    if isinstance(field.dataType, T.LongType):
        return coerce.to_long(value)
    if isinstance(field.dataType, T.TimestampType):
        return coerce.to_time(value)
    return value.try_cast(field.dataType)


def to_staging(silver: DataFrame, order: list[str]) -> DataFrame:
    """Usable rows, last copy of each event, in the staging layout."""
    usable = valid_rows(silver)
    latest = keep_last(usable, ["event_id"], order)
    return conform(
        latest.withColumn("event_date", F.to_date("event_time")), schemas.STAGING
    )
