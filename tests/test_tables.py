"""Sinks: snapshots, incremental facts, reports, backfill."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripflow import schemas
from tripflow.operators.conform import conform
from tripflow.plans import facts
from tripflow.sinks import report
from tripflow.sinks.backfill import backfill_silver
from tripflow.sinks.buckets import BucketedTable
from tripflow.sinks.incremental import IncrementalFact
from tripflow.sinks.snapshots import SnapshotTable
from tripflow.sources.lake import read_layer, read_silver, read_source_file


def pairs(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def test_snapshot_writes(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.upsert(pairs(spark, [("a", 1), ("b", 2)]), ["k"])
    before = table.read()
    table.upsert(pairs(spark, [("b", 3), ("c", 4)]), ["k"])
    assert sorted(table.read().collect()) == [("a", 1), ("b", 3), ("c", 4)]
    # A reader of the old version is not disturbed.
    assert sorted(before.collect()) == [("a", 1), ("b", 2)]
    table.insert_absent(pairs(spark, [("c", 9), ("d", 5)]), ["k"])
    table.append_keep_last(pairs(spark, [("a", 7)]), ["k"])
    table.set_fields(pairs(spark, [("d", 6)]), ["k"])
    assert sorted(table.read().collect()) == [("a", 7), ("b", 3), ("c", 4), ("d", 6)]
    table.replace(pairs(spark, []))
    assert table.read().count() == 0


def event(number, trip, at, **more):
    return {"event_id": f"e{number}", "trip_id": trip, "city_id": "NYC", "event_time": at, **more}


def start(day, hour=0):
    return datetime(2024, 1, day, hour)


def test_incremental_fact_equals_replacement_in_memory(spark, staging, tmp_path):
    first = [event(1, "t1", start(1)), event(2, "t1", start(1, 1)), event(3, "t2", start(2)), event(4, "t3", start(3))]
    later = [event(5, "t1", start(4)), event(6, "t4", start(4, 1)), event(7, "t2", start(5)), event(8, "t9", start(2, 5))]
    table = IncrementalFact(spark, "fact_trip", str(tmp_path))
    table.load(staging(*first))
    assert table.high_water() == start(3)
    untouched = {p.name for p in (tmp_path / "fact_trip/data/created_date=2024-01-03").glob("*.parquet")}

    table.load(staging(*first, *later))
    rows = sorted((r["trip_id"], r["created_at"]) for r in table.read().collect())
    # t9 lies before the mark and stays out. All of t1 and t2 gives way to the new rows.
    assert rows == [("t1", start(4)), ("t2", start(5)), ("t3", start(3)), ("t4", start(4, 1))]
    assert table.high_water() == start(5)
    # A day without a replaced row keeps its files; a day left empty is gone.
    assert {p.name for p in (tmp_path / "fact_trip/data/created_date=2024-01-03").glob("*.parquet")} == untouched
    assert not (tmp_path / "fact_trip/data/created_date=2024-01-01").exists()

    table.load(staging(*first, *later))
    assert sorted((r["trip_id"], r["created_at"]) for r in table.read().collect()) == rows


def test_one_day_load_touches_only_its_day(spark, staging, tmp_path):
    """Other days are neither scanned nor written; their keys are looked up by hash alone."""
    first = [event(100 * d + i, f"t{d}-{i}", start(d, i % 24)) for d in range(1, 9) for i in range(30)]
    table = IncrementalFact(spark, "fact_trip", str(tmp_path))
    table.load(staging(*first))
    data, keys = tmp_path / "fact_trip/data", tmp_path / "fact_trip/keys"

    def files(root):
        return {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in root.glob("created_date=*")}

    before = files(data), files(keys)
    assert set(before[0]) == set(before[1]) and len(before[0]) == 8
    # New trips of day 9, and one of day 8 again.
    later = [event(1000 + i, f"n{i}", start(9, i % 24)) for i in range(30)] + [event(1100, "t8-3", start(9, 5))]
    batch = table.fact.build(staging(*later)).withColumn("created_date", F.to_date("created_at"))
    days = table.days_with(batch)
    assert [str(r[0]) for r in days.collect()] == ["2024-01-08"]
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "key_hash:bigint" in plan and "trip_fact_key:string" not in plan
    touched = {date(2024, 1, 8), date(2024, 1, 9)}
    plan = table.unreplaced(batch, touched)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[created_date#\d+ IN \(2024-01-08,2024-01-09\)\]", plan), plan
    table.load(staging(*first, *later))
    after = files(data), files(keys)
    for old, new in zip(before, after):
        assert {d: f for d, f in new.items() if d < "created_date=2024-01-08"} == {d: f for d, f in old.items() if d < "created_date=2024-01-08"}
        assert old["created_date=2024-01-08"] != new["created_date=2024-01-08"] and len(new) == 9
    rows = {(r["trip_id"], r["created_at"]) for r in table.read().collect()}
    assert len(rows) == 240 - 1 + 31 and ("t8-3", start(9, 5)) in rows and ("t8-3", start(8, 3)) not in rows
    assert table.keys().count() == len(rows)
    # What a finished load wrote beside the table is gone.
    assert not list((tmp_path / "fact_trip/changes").glob("*/days"))


def test_keys_of_an_older_table_are_made_once(spark, staging, tmp_path):
    import shutil

    table = IncrementalFact(spark, "fact_trip", str(tmp_path))
    table.load(staging(event(1, "t1", start(1)), event(2, "t2", start(2))))
    shutil.rmtree(tmp_path / "fact_trip/keys")
    table.load(staging(event(3, "t1", start(3))))
    assert {(r["trip_id"], r["created_at"]) for r in table.read().collect()} == {("t1", start(3)), ("t2", start(2))}
    assert table.keys().count() == 2


def test_incremental_fact_finishes_a_load_that_died(spark, staging, tmp_path, monkeypatch):
    first, later = [event(1, "t1", start(1))], [event(2, "t1", start(2)), event(3, "t2", start(2))]
    whole = IncrementalFact(spark, "fact_trip", str(tmp_path / "whole"))
    broken = IncrementalFact(spark, "fact_trip", str(tmp_path / "broken"))
    for table in (whole, broken):
        table.load(staging(*first))
    whole.load(staging(*first, *later))
    wanted = sorted(map(str, whole.read().collect()))

    # Dies while the days are being overwritten: one of them is gone, the mark is old.
    def die(*_):
        broken._drop_day("2024-01-01")
        raise RuntimeError("lost driver")

    monkeypatch.setattr(broken, "_write", die)
    with pytest.raises(RuntimeError):
        broken.load(staging(*first, *later))
    monkeypatch.undo()
    assert broken.high_water() == start(1)
    broken.load(staging(*first, *later))
    assert sorted(map(str, broken.read().collect())) == wanted
    assert broken.high_water() == start(2)


def test_incremental_fact_applies_a_change_twice(spark, staging, tmp_path, monkeypatch):
    """Dies after the days were overwritten, before the mark: the same change once more alters nothing."""
    first, later = [event(1, "t1", start(1))], [event(2, "t1", start(2)), event(3, "t2", start(2))]
    table = IncrementalFact(spark, "fact_trip", str(tmp_path))
    table.load(staging(*first))

    def die(*_):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(table, "_advance", die)
    with pytest.raises(RuntimeError):
        table.load(staging(*first, *later))
    monkeypatch.undo()
    assert table.high_water() == start(1)
    written = sorted(map(str, table.read().collect()))
    table.apply_pending()
    assert table.high_water() == start(2) and len(written) == 2
    assert sorted(map(str, table.read().collect())) == written


def test_new_fact_columns_are_null_in_older_rows(spark, staging, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from tripflow.plans.facts import FACTS, Fact

    table = IncrementalFact(spark, "fact_trip", str(tmp_path))
    table.load(staging(event(1, "t1", start(1)), event(2, "t2", start(1))))
    old = FACTS["fact_trip"]
    table.fact = Fact(old.key, old.known, lambda: {**old.columns(), "extra": F.lit(7)})
    table.load(staging(event(3, "t1", start(2))))
    assert {r["trip_id"]: r["extra"] for r in table.read().collect()} == {"t1": 7, "t2": None}


def test_lookback_admits_late_events(spark, staging, tmp_path):
    table = IncrementalFact(spark, "fact_trip", str(tmp_path))
    table.load(staging(event(1, "t1", start(3))))
    late = staging(event(1, "t1", start(3)), event(2, "t2", start(2)))
    table.load(late)
    assert table.read().count() == 1
    table.load(late, lookback=timedelta(days=2))
    assert table.read().count() == 2


def test_first_load_keeps_repeated_keys(spark, staging):
    rows = staging(event(1, "t1", start(1)), event(2, "t1", start(2)))
    assert facts.fact("fact_trip", rows).count() == 2


def test_reports(spark, tmp_path):
    pairs(spark, [("a", 1), ("b", 2)]).write.parquet(str(tmp_path / "data"))
    frame = spark.read.schema("k string, v int").parquet(str(tmp_path / "data"))
    inventory = report.inventory(spark, {"pairs": frame, "none": frame.limit(0)}, {"pairs": str(tmp_path / "data")})
    rows = {r["relation"]: r for r in inventory.collect()}
    size = sum(p.stat().st_size for p in (tmp_path / "data").glob("*.parquet"))
    assert (rows["pairs"]["row_count"], rows["pairs"]["size_bytes"]) == (2, size)
    assert (rows["none"]["row_count"], rows["none"]["size_bytes"]) == (0, None)
    report.write_csv(inventory, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 2
    report.write_markdown(inventory, str(tmp_path / "report.md"))
    text = (tmp_path / "report.md").read_text()
    assert "Relations scanned: 2" in text and "Total rows (summed): 2" in text
    assert "| lake | none | BASE TABLE | 0 | n/a |" in text


def test_catalog_relations(spark):
    pairs(spark, [("a", 1)]).createOrReplaceTempView("tripflow_pairs")
    assert "tripflow_pairs" not in report.catalog_relations(spark)
    assert report.catalog_relations(spark, include_views=True)["tripflow_pairs"].count() == 1


def test_bucketed_table_rewrites_touched_buckets_only(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path), ["k"], buckets=16)
    table.upsert(pairs(spark, [(f"k{i}", i) for i in range(400)]))

    def files():
        return {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in (tmp_path / "data").glob("_bucket=*")}

    before = files()
    assert len(before) == 16
    table.upsert(pairs(spark, [("k7", 70), ("new", 1)]))
    changed = {b for b, f in files().items() if before[b] != f}
    assert 1 <= len(changed) <= 2
    plan = table.held([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    rows = dict(map(tuple, table.read().collect()))
    assert rows == {f"k{i}": i for i in range(400)} | {"k7": 70, "new": 1}
    table.insert_absent(pairs(spark, [("k7", 0), ("k8", 0), ("other", 2)]))
    assert dict(map(tuple, table.read().collect())) == rows | {"other": 2}
    # A field that is new, and one that an update doesn't carry.
    table.set_fields(spark.createDataFrame([("k8", True)], "k string, flag boolean"))
    found = {r["k"]: r for r in table.read().collect()}
    assert (found["k8"]["v"], found["k8"]["flag"], found["k9"]["flag"]) == (8, True, None)
    # Null keys and an empty load.
    table.upsert(pairs(spark, [(None, 5)]).limit(0).unionByName(pairs(spark, [("z", 5)])))
    table.upsert(pairs(spark, [("a", 1)]).limit(0))
    assert table.read().count() == 403 and not list((tmp_path / "changes").iterdir())


def test_bucketed_table_finishes_a_load_that_died(spark, tmp_path, monkeypatch):
    table = BucketedTable(spark, str(tmp_path), ["k"], buckets=4)
    table.upsert(pairs(spark, [("a", 1), ("b", 2)]))

    def die():
        raise RuntimeError("lost driver")

    calls = iter([table.apply_pending, die])
    monkeypatch.setattr(table, "apply_pending", lambda: next(calls)())
    with pytest.raises(RuntimeError):
        table.upsert(pairs(spark, [("b", 3)]))
    monkeypatch.undo()
    assert dict(map(tuple, table.read().collect())) == {"a": 1, "b": 2}
    table.insert_absent(pairs(spark, [("b", 9), ("c", 4)]))
    assert dict(map(tuple, table.read().collect())) == {"a": 1, "b": 3, "c": 4}


def test_inventory_counts_what_cannot_be_read_as_null(spark, staging, tmp_path):
    import shutil

    from tripflow.jobs import Warehouse

    house = Warehouse(spark, str(tmp_path))
    for name in ("dim_city", "dim_rider"):
        house.snapshot(name).replace(pairs(spark, [("a", 1)]))
    house.fact("fact_trip").load(staging(event(1, "t1", start(1))))
    shutil.rmtree(house.snapshot("dim_rider").path)
    frames, paths = house.relations()
    assert frames["dim_rider"] is None and set(paths) == {"dim_city", "fact_trip"}
    listed = {r["relation"]: r for r in report.inventory(spark, frames, paths).collect()}
    assert {n: r["row_count"] for n, r in listed.items()} == {"dim_city": 1, "dim_rider": None, "fact_trip": 1}
    assert listed["dim_rider"]["size_bytes"] is None and listed["fact_trip"]["size_bytes"] > 0


def silver_rows(spark, staging, *rows):
    return conform(staging(*rows), schemas.SILVER)


def test_backfill_adds_only_unknown_events(spark, staging, tmp_path):
    root = str(tmp_path / "silver")
    held = silver_rows(spark, staging, event(1, "t1", start(1)), event(2, "t1", start(2)))
    held.write.partitionBy("event_date", "city_id").parquet(f"{root}/canonical_events")
    history = staging(event(2, "t1", start(2)), event(3, "t2", start(1)), event(3, "t2", start(1)), {"event_id": "x"})
    assert backfill_silver(spark, history, root) == 1
    rows = read_silver(spark, root)
    assert sorted(r["event_id"] for r in rows.collect()) == ["e1", "e2", "e3"]
    assert backfill_silver(spark, history, root) == 0


def test_layers_and_source_files(spark, tmp_path):
    frame = pairs(spark, [("a", 1), ("b", 2)])
    frame.write.parquet(str(tmp_path / "x.parquet"))
    frame.write.option("header", "true").csv(str(tmp_path / "x.csv"))
    assert read_layer(spark, str(tmp_path / "x.parquet"), frame.schema).count() == 2
    assert read_source_file(spark, str(tmp_path / "x.parquet")).count() == 2
    text = read_source_file(spark, str(tmp_path / "x.csv"))
    assert dict(text.dtypes) == {"k": "string", "v": "string"}
