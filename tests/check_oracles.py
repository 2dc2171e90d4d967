"""Run named queries against their SQL: python tests/check_oracles.py [sf_dir] [name ...]."""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tripflow.session import build_session  # noqa: E402
from tripflow.sources.tables import TABLES  # noqa: E402


def local_session():
    return build_session(
        "tripflow-check", "local[8]",
        spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )


def connect(sf_dir: str):
    db = duckdb.connect()
    db.execute("set timezone='UTC'")
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, bytes)):
        return repr(value)
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(value) + 0.0)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else repr(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, db, sf_dir: str, name: str) -> str | None:
    frame = entry.queries()[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None
    wanted_columns = [c[0] for c in db.execute(f"describe {sql}").fetchall()]
    wanted = rows_of(wanted_columns, db.execute(sql).fetchall())
    if sorted(frame.columns) != sorted(wanted_columns):
        return f"columns {sorted(frame.columns)} != {sorted(wanted_columns)}"
    if len(got) != len(wanted):
        return f"rows {len(got)} != {len(wanted)}"
    wrong = [(a, b) for a, b in zip(got, wanted) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]} in {sorted(frame.columns)}"
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark, db = local_session(), connect(sf_dir)
    bad = 0
    for name in names:
        started = time.perf_counter()
        try:
            problem = compare(spark, db, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        seconds = time.perf_counter() - started
        checked = "oracle" if name in entry.oracle_sql() else "rows only"
        print(f"{'FAIL' if problem else 'ok':4} {seconds:7.2f}s {name} ({checked}) {problem or ''}", flush=True)
        bad += bool(problem)
    print(f"{len(names) - bad} of {len(names)} agree")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
