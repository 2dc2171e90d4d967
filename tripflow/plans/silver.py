"""From raw messages to canonical events; shared by batch and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripflow import schemas
from tripflow.functions import coerce
from tripflow.settings import COMPLETED, ENTITY_OF_TOPIC


def to_bronze(messages: DataFrame, entity: str | None = None) -> DataFrame:
    """Envelope projection. Without an entity, the topic name decides."""
    if entity is None:
        pairs = [F.lit(x) for item in ENTITY_OF_TOPIC.items() for x in item]
        bronze_entity = F.create_map(*pairs)[F.col("topic")]
    else:
        bronze_entity = F.lit(entity)
    return messages.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        "timestampType",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.current_timestamp().alias("ingestion_time"),
        bronze_entity.alias("bronze_entity"),
        F.to_date(F.current_timestamp()).alias("ingest_date"),
    )


PAYLOAD_FIELDS = [
    "event_id", "event_type", "event_time", *schemas.PAYLOAD_STRINGS, *schemas.PAYLOAD_DOUBLES,
    "amount", *schemas.PAYLOAD_LONGS, "source_system", "schema_version",
]


def with_payload(bronze: DataFrame, fields: list[str] = PAYLOAD_FIELDS) -> DataFrame:
    """Parse the named fields of the JSON text, as text; casts follow.

    Anything but an object gives NULL in every field. Naming the fields spares
    the parser the others, where a map would hold them all.
    """
    parsed = StructType([StructField(name, StringType()) for name in fields])
    return bronze.withColumn("payload", F.from_json("value", parsed))


def with_keys(bronze: DataFrame) -> DataFrame:
    """Envelope, and beside it what validity, deduplication and layout need of the text.

    The fields come out of a generator, because a filter on them would otherwise be moved below the
    parser, which would then run once more for each condition. The other fields are best parsed
    after the rows have moved: the text is smaller than the columns made of it.
    """
    parsed = StructType([StructField(name, StringType()) for name in ("event_id", "event_time", "city_id")])
    keyed = bronze.select("*", F.inline(F.array(F.from_json("value", parsed))))
    keyed = keyed.withColumn("event_time", coerce.to_time(F.col("event_time")))
    return keyed.withColumn("event_date", F.to_date("event_time"))


def _field(name: str) -> Column:
    return F.col("payload")[name]


def _payment_amount() -> Column:
    """Either key may carry the amount; an empty or zero first one does not count."""
    named = _field("payment_amount")
    unusable = (named == "") | F.coalesce(coerce.to_double(named) == 0, F.lit(False))
    return coerce.to_double(F.coalesce(F.when(~unusable, named), _field("amount")))


def to_canonical(bronze: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Canonical columns; ``extra`` adds columns of the envelope after them."""
    columns = {
        "source_topic": F.col("topic"),
        "bronze_entity": F.col("bronze_entity"),
        "ingestion_time": F.col("ingestion_time"),
        "event_time": coerce.to_time(_field("event_time")),
        "payment_amount": _payment_amount(),
        "raw_payload": F.col("value"),
    }
    columns["event_date"] = F.to_date(columns["event_time"])
    chosen = []
    for field in schemas.SILVER.fields:
        if field.name in columns:
            value = columns[field.name]
        elif field.name in schemas.PAYLOAD_DOUBLES:
            value = coerce.to_double(_field(field.name))
        elif field.name in schemas.PAYLOAD_LONGS:
            value = coerce.to_long(_field(field.name))
        else:
            value = _field(field.name)
        chosen.append(value.alias(field.name))
    chosen += [column.alias(name) for name, column in (extra or {}).items()]
    return with_payload(bronze).select(*chosen)


def completed_trip_payloads(messages: DataFrame) -> DataFrame:
    """Messages the loader validates: completed trips that name a trip."""
    parsed = with_payload(messages, ["event_type", "trip_id"])
    return parsed.filter(
        (_field("event_type") == COMPLETED)
        & _field("trip_id").isNotNull()
        & (_field("trip_id") != "")
    )
