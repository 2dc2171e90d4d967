"""Shape of the physical plans: what must not appear, and what must."""

import pytest

from tripflow.operators.dedup import keep_last
from tripflow.registry.queries import QUERIES
from tripflow.sources import tables
from tripflow.sources.warehouse import lazy_staging

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(n for n in QUERIES if not n.startswith(("train_", "score_")))


@pytest.fixture(autouse=True)
def whole_plans(spark):
    settings = {"spark.sql.maxMetadataStringLength": "100000", "spark.sql.debug.maxToStringFields": "1000"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_product_no_python_rows_no_window_in_one_task(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in plan, plan
    # A window right above a single-partition exchange would have no partition columns.
    lines = plan.splitlines()
    for number, line in enumerate(lines):
        if "Window [" in line:
            assert not any("Exchange SinglePartition" in below for below in lines[number : number + 4])


def test_last_day_reads_one_partition(spark):
    plan = plan_of(QUERIES["serve_latest_trips"](spark, SF_DIR))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "Subquery" in plan


def test_kpis_read_only_their_columns(spark):
    plan = plan_of(QUERIES["mart_city_daily_kpis"](spark, SF_DIR))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "event_type", "fare_total", "surge_multiplier", "platform_fee", "driver_payout",
    }


def test_day_filter_reaches_the_scan(spark):
    from datetime import date

    from tripflow.plans import opendata

    source = tables.table(spark, SF_DIR, "orders").withColumnRenamed("o_orderdate", "trip_start_timestamp")
    plan = plan_of(opendata.only_day(source, opendata.CHICAGO, date(1998, 5, 5)))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_deduplication_limits_before_the_shuffle(spark):
    lines = plan_of(lazy_staging(spark, SF_DIR)).splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(event_id" in line)
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["serve_city_daily"](spark, SF_DIR))


def test_keep_last_needs_one_shuffle(spark):
    frame = tables.table(spark, SF_DIR, "orders")
    assert plan_of(keep_last(frame, ["o_custkey"], ["o_orderdate"])).count("Exchange") == 1
