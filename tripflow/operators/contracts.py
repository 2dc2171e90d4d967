"""Contract checks of a frame in two passes: one for all conditions on rows, one for the key."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tripflow.functions import coerce
from tripflow.session import fresh_dir

log = logging.getLogger(__name__)

# Stands for the frame itself among the counted lines.
_ALL_ROWS = "rows"


class ContractViolation(ValueError):
    """The frame breaks its contract and the mode is ``enforce``."""


def missing_columns(frame: DataFrame, contract: dict) -> list[str]:
    return [c for c in contract.get("required_fields", []) if c not in frame.columns]


def _number(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.NumericType):
        return value.cast("double")
    if isinstance(field.dataType, T.StringType):
        return coerce.to_double(value)
    return F.lit(None).cast("double")


def _unusable(field: T.StructField, kind: str) -> Column | None:
    """Condition for a non-null value the declared type rejects."""
    value = F.col(field.name)
    base = kind.replace("|null", "")
    given = field.dataType
    if base in ("float", "integer"):
        if isinstance(given, T.NumericType):
            return None
        return value.isNotNull() & _number(field).isNull()
    if base == "timestamp":
        if isinstance(given, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return None
        return value.isNotNull() & coerce.to_time(value).isNull()
    if base == "string" and isinstance(given, (T.ArrayType, T.MapType, T.StructType)):
        return value.isNotNull()
    return None


def _conditions(frame: DataFrame, contract: dict) -> list[tuple[str, str, Column]]:
    """(check, column, condition of a violating row) for every row-level rule."""
    fields = {f.name: f for f in frame.schema.fields}
    rules = contract.get("quality_rules", {})
    found = []
    for name in rules.get("not_null", []):
        if name in fields:
            found.append(("not_null", name, F.col(name).isNull()))
    for name in rules.get("non_negative", []):
        if name in fields:
            found.append(("non_negative", name, _number(fields[name]) < 0))
    for name, kind in contract.get("field_types", {}).items():
        if name in fields:
            condition = _unusable(fields[name], kind)
            if condition is not None:
                found.append((f"type_{kind.replace('|null', '')}", name, condition))
    return found


def disallowed_values(frame: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Distinct values outside the allowed set, with the rows that hold them."""
    value = F.col(column).cast("string")
    return (
        frame.filter(value.isNotNull() & ~value.isin(allowed))
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _line(check: str, column: str | Column, detail: Column) -> list[Column]:
    name = F.lit(column) if isinstance(column, str) else column
    return [
        F.lit(check).alias("check_name"),
        name.alias("column_name"),
        detail.cast("string").alias("detail"),
        F.col("rows").cast("bigint").alias("rows"),
    ]


def _counted(frame: DataFrame, contract: dict) -> DataFrame:
    """Rows per broken condition, per distinct value for the allowed-value rules, and of the frame:
    every row is looked at once and names what it breaks."""
    text = F.lit(None).cast("string")

    def broken(check: str, column: str, condition: Column, detail: Column = text) -> Column:
        return F.when(condition, F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), detail.alias("detail")))

    entries = [broken(_ALL_ROWS, "", F.lit(True))]
    entries += [broken(check, column, condition) for check, column, condition in _conditions(frame, contract)]
    for column, allowed in contract.get("quality_rules", {}).get("allowed", {}).items():
        if column in frame.columns:
            value = F.col(column).cast("string")
            entries.append(broken("allowed_values", column, value.isNotNull() & ~value.isin(allowed), value))
    named = frame.select(F.explode(F.array_compact(F.array(*entries))).alias("entry")).select("entry.*")
    return named.groupBy("check_name", "column_name", "detail").agg(F.count(F.lit(1)).alias("rows"))


def _lines(frame: DataFrame, contract: dict) -> DataFrame:
    parts = [_counted(frame, contract)]
    key = contract.get("primary_key", [])
    if key and all(c in frame.columns for c in key):
        from tripflow.operators.dedup import repeated_row_count

        repeats = repeated_row_count(frame, key, "rows").filter(F.col("rows") > 0)
        parts.append(
            repeats.select(*_line("primary_key", ",".join(key), F.lit(None)))
        )
    for name in missing_columns(frame, contract):
        marker = frame.sparkSession.range(1).withColumn("rows", F.lit(None).cast("bigint"))
        parts.append(marker.select(*_line("required_column", name, F.lit(None))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def violations(frame: DataFrame, contract: dict) -> DataFrame:
    """One row per broken rule; one per distinct value for the allowed-value rules."""
    return _lines(frame, contract).filter(F.col("check_name") != _ALL_ROWS)


_MESSAGES = {
    "not_null": "Column '{column}' has {rows} null values",
    "non_negative": "Column '{column}' has {rows} negative values",
    "type_float": "Column '{column}' has {rows} non-float values",
    "type_integer": "Column '{column}' has {rows} non-integer values",
    "type_timestamp": "Column '{column}' has {rows} non-timestamp values",
    "type_string": "Column '{column}' has {rows} non-string-like values",
}


def validate(frame: DataFrame, contract: dict) -> dict:
    """Summary with one message per broken rule, in the order of the contract.

    The frame is evaluated twice. The violations lie in the folder the summary names, with every
    value that isn't allowed; messages tell their number, so they stay short at any size.
    """
    path = fresh_dir(frame.sparkSession, "violations")
    lines = _lines(frame, contract)
    lines.write.parquet(path)
    found = frame.sparkSession.read.schema(lines.schema).parquet(path)
    by_rule = (
        found.filter(F.col("check_name") != "required_column")
        .groupBy("check_name", "column_name")
        .agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("lines"))
        .collect()
    )
    rules = {(r["check_name"], r["column_name"]): r for r in by_rule}
    errors = []
    gaps = missing_columns(frame, contract)
    if gaps:
        errors.append(f"Missing required columns: {gaps}")
    order = [(check, column) for check, column, _ in _conditions(frame, contract)]
    row_rules = [o for o in order if not o[0].startswith("type_")]
    type_rules = [o for o in order if o[0].startswith("type_")]
    for rule in row_rules:
        if rule in rules:
            errors.append(_MESSAGES[rule[0]].format(column=rule[1], rows=rules[rule]["rows"]))
    for column in contract.get("quality_rules", {}).get("allowed", {}):
        rule = ("allowed_values", column)
        if rule in rules:
            errors.append(
                f"Column '{column}' has {rules[rule]['lines']} distinct disallowed values "
                f"in {rules[rule]['rows']} rows"
            )
    key = contract.get("primary_key", [])
    rule = ("primary_key", ",".join(key))
    if rule in rules:
        errors.append(f"Primary key {key} has {rules[rule]['rows']} duplicate rows")
    for rule in type_rules:
        if rule in rules:
            errors.append(_MESSAGES[rule[0]].format(column=rule[1], rows=rules[rule]["rows"]))
    return {
        "valid": not errors,
        "row_count": rules[_ALL_ROWS, ""]["rows"] if (_ALL_ROWS, "") in rules else 0,
        "error_count": len(errors),
        "errors": errors,
        "contract_name": contract.get("contract_name"),
        "contract_version": contract.get("version"),
        "violations": path,
    }


def gate(frame: DataFrame, contract: dict, mode: str = "enforce") -> dict:
    """Validate; raise in ``enforce`` mode, log in ``warn`` mode."""
    summary = validate(frame, contract)
    summary["mode"] = mode
    if not summary["valid"]:
        if mode == "enforce":
            raise ContractViolation(f"Contract validation failed: {summary['errors']}")
        log.warning("contract %s: %s", summary["contract_name"], summary["errors"])
    return summary
