"""Streaming jobs over files, batch by batch."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripflow import jobs, schemas, settings
from tripflow.operators.validity import quarantined_rows, valid_rows
from tripflow.plans import gold as gold_plan
from tripflow.plans.silver import to_canonical, with_keys
from tripflow.session import temporarily
from tripflow.sinks import backfill
from tripflow.sinks.backfill import backfill_gold, backfill_silver, history_days
from tripflow.sources.lake import read_gold, read_silver
from tripflow.sources.topics import land_messages, read_topic
from tripflow.streaming import bronze, gold, silver
from tripflow.streaming.run import ProgressLog, await_all

TRIPS = settings.TOPICS[0]
FRAUD = settings.TOPICS[10]
START = datetime(2024, 1, 1)


def message(offset, event_id, minutes, topic=TRIPS["name"], **more):
    at = START + timedelta(minutes=minutes)
    payload = {"event_id": event_id, "event_time": at.isoformat() + "Z", "city_id": "NYC", "event_type": "trip_completed", "fare_total": 10.0, **more}
    return (event_id, json.dumps(payload), topic, 0, offset, at, 0)


class Lake:
    """Topics, bronze, silver and gold below one folder."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)

    def publish(self, *messages):
        frame = self.spark.createDataFrame(
            list(messages), "key string, value string, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
        )
        frame.coalesce(1).write.mode("append").partitionBy("topic").parquet(f"{self.root}/topics")

    def run(self, topics=(TRIPS,)):
        marks = f"{self.root}/marks"
        await_all(bronze.start_all(self.spark, f"{self.root}/bronze", f"{marks}/b", bounded=True, topics=list(topics), files=f"{self.root}/topics"))
        queries = silver.start(self.spark, f"{self.root}/bronze", f"{self.root}/silver", f"{marks}/s", bounded=True)
        log = ProgressLog(self.spark, f"{self.root}/progress")
        await_all(queries, log)
        self.late = {r["name"]: r["late_rows"] for r in log.late_rows().collect()}
        await_all([gold.start(self.spark, f"{self.root}/silver", f"{self.root}/gold", f"{marks}/g", bounded=True)])

    def events(self):
        rows = self.spark.read.schema(schemas.SILVER).parquet(f"{self.root}/silver/canonical_events")
        return sorted(r["event_id"] for r in rows.select("event_id").collect())

    def quarantine(self):
        return self.spark.read.schema(schemas.SILVER).parquet(f"{self.root}/silver/quarantine_events").count()

    def hours(self):
        rows = self.spark.read.schema(schemas.GOLD_HOURLY).parquet(f"{self.root}/gold/city_hourly_metrics")
        return {r["window_start"].hour: (r["completed_trips"], r["gross_fare_total"]) for r in rows.collect()}


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_layers_over_three_batches(lake):
    lake.publish(
        message(0, "a", 5), message(1, "b", 50), message(2, "b", 50), message(3, "c", 70, city_id=None),
        message(4, None, 75), message(5, "d", 100),
    )
    lake.run()
    assert lake.events() == ["a", "b", "d"]
    assert lake.quarantine() == 2
    # The watermark stands at 01:10; hour 0 is closed, hour 1 is not.
    assert lake.hours() == {0: (2, 20.0)}

    # A copy within the watermark is dropped across batches, and the sentinel closes hour 1.
    lake.publish(message(6, "d", 100), message(7, "e", 110), message(8, "z", 300))
    lake.run()
    assert lake.events() == ["a", "b", "d", "e", "z"]
    assert lake.hours() == {0: (2, 20.0), 1: (2, 20.0)}

    # Far behind the watermark: in neither output, but counted.
    lake.publish(message(9, "late", 10), message(10, "y", 310))
    lake.run()
    assert lake.events() == ["a", "b", "d", "e", "y", "z"]
    assert lake.quarantine() == 2
    assert lake.late["silver_canonical_events"] == 1


def test_late_rows_of_all_batches_are_counted(spark, tmp_path):
    """More batches than a query holds reports of, over two runs of it."""
    files = tmp_path / "in"
    (files / "a").mkdir(parents=True)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    try:
        for turn in range(2):
            for i in range(7):
                # Every file but the first holds a row far behind the watermark.
                n = 7 * turn + i
                rows = [f'{{"id": "x{n}", "t": "2024-01-01T{n:02d}:00:00"}}', f'{{"id": "late{n}", "t": "2023-01-01T00:00:00"}}']
                (files / f"{n:02d}.json").write_text("\n".join(rows))
            events = spark.readStream.schema("id string, t timestamp").option("maxFilesPerTrigger", 1).json(str(files))
            query = (
                events.withWatermark("t", "1 day").dropDuplicatesWithinWatermark(["id"]).writeStream.queryName("late counts")
                .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "marks")).trigger(availableNow=True).start()
            )
            log = ProgressLog(spark, str(tmp_path / "log"))
            await_all([query], log, seconds=0.2)
            assert len(query.recentProgress) < 7
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "10000")
    found = log.late_rows().first()
    assert found["name"] == "late counts" and found["batches"] >= 14
    assert found["late_rows"] == 28 - spark.read.schema("id string, t timestamp").parquet(str(tmp_path / "out")).count() == 12


def test_an_id_with_a_third_of_the_rows(lake):
    """Its copies are dropped lane by lane; a batch that runs again after its commit was lost repeats
    and loses nothing."""
    def publish(turn):
        lake.publish(*[message(1000 * turn + i, "hot" if i % 3 == 0 else f"e{turn}-{i}", 30 + i % 20) for i in range(600)])

    publish(0)
    lake.run()
    wanted = {"hot"} | {f"e0-{i}" for i in range(600) if i % 3}
    assert lake.events() == sorted(wanted)
    report = json.loads(sorted((lake_path(lake) / "progress").rglob("*-0.json"))[0].read_text())
    last, first = report["stateOperators"]
    lanes = lake.spark.sparkContext.defaultParallelism
    # Lanes of the hot id, and the other ids once each.
    assert first["numRowsTotal"] <= 400 + lanes and last["numRowsTotal"] == 401
    assert last["customMetrics"]["numDroppedDuplicateRows"] == first["numRowsTotal"] - 401 <= lanes - 1

    marks = lake_path(lake) / "marks/s/canonical_events/commits"
    newest = max(int(f.name) for f in marks.iterdir() if f.name.isdigit())
    for name in (f"{newest}", f".{newest}.crc"):
        (marks / name).unlink()
    publish(1)
    lake.run()
    assert lake.events() == sorted(wanted | {f"e1-{i}" for i in range(600) if i % 3})


def lake_path(lake):
    from pathlib import Path

    return Path(lake.root)


def test_unusable_copy_first_does_not_cost_the_usable_one(lake):
    lake.publish(message(0, "a", 5, city_id=None), message(1, "a", 5), message(2, "b", 200))
    lake.run()
    assert lake.events() == ["a", "b"]
    assert lake.quarantine() == 1


def test_topics_fan_out_into_entities(lake):
    lake.publish(message(0, "a", 5), message(0, "f", 6, topic=FRAUD["name"], fraud_case_id="f", fraud_score=0.9))
    lake.run(topics=(TRIPS, FRAUD))
    rows = lake.spark.read.schema(schemas.BRONZE).option("recursiveFileLookup", "true").parquet(f"{lake.root}/bronze")
    assert {r["topic"]: r["bronze_entity"] for r in rows.collect()} == {
        TRIPS["name"]: "op_trip_events", FRAUD["name"]: "op_fraud_signal_events",
    }
    assert lake.events() == ["a", "f"]


def test_stream_and_batch_agree_on_closed_hours(lake, spark):
    lake.publish(*[message(i, f"e{i}", (i * 37) % 600, surge_multiplier=1 + i % 3) for i in range(200)], message(999, "z", 900))
    lake.run()
    silver_rows = spark.read.schema(schemas.SILVER).parquet(f"{lake.root}/silver/canonical_events")
    batch = {r["window_start"].hour: (r["completed_trips"], r["gross_fare_total"]) for r in gold_plan.city_hourly(silver_rows).collect()}
    batch.pop(15)
    assert lake.hours() == batch


def test_bounded_read_takes_all(spark, lake):
    rows = [message(i, f"e{i}", 100 - i) for i in range(10)]
    frame = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint, timestamp timestamp, timestampType int")
    land_messages(frame, f"{lake.root}/topics")
    assert read_topic(spark, TRIPS["name"], files=f"{lake.root}/topics").count() == 10


def test_backfill_shows_on_a_streamed_silver(spark, lake, staging):
    lake.publish(*[message(i, f"e{i}", i) for i in range(20)])
    lake.run()
    root = f"{lake.root}/silver"
    before = read_silver(spark, root)
    held = before.count()
    history = before.limit(3).unionByName(before.limit(2).withColumn("event_id", F.concat(F.lit("old-"), "event_id")))
    assert backfill_silver(spark, history, root) == 2
    assert read_silver(spark, root).count() == held + 2
    assert backfill_silver(spark, history, root) == 0


def test_backfill_decides_on_keys_which_rows_to_take(spark, lake):
    """Copies of an id, equal ones too, give its last row; only the places of rows are kept until then."""
    lake.publish(*[message(i, f"e{i}", i) for i in range(4)])
    lake.run()
    root = f"{lake.root}/silver"
    row = read_silver(spark, root).where("event_id = 'e1'")

    def copy(event_id, fare, at):
        made = row.withColumn("event_id", F.lit(event_id)).withColumn("fare_total", F.lit(fare))
        return made.withColumn("ingestion_time", F.lit(at).cast("timestamp"))

    last = copy("new", 3.0, "2024-02-02")
    history = row.unionByName(copy("new", 1.0, None)).unionByName(last).unionByName(last).unionByName(copy("new", 2.0, "2024-02-01"))
    kept = []
    path = backfill.fresh_dir
    backfill.fresh_dir = lambda *args: kept.append(path(*args)) or kept[-1]
    try:
        assert [backfill_silver(spark, history, root) for _ in range(2)] == [1, 0]
    finally:
        backfill.fresh_dir = path
    assert [r["fare_total"] for r in read_silver(spark, root).where("event_id = 'new'").collect()] == [3.0]
    assert read_silver(spark, root).count() == 5
    assert sorted(spark.read.parquet(kept[1]).columns) == sorted(spark.read.parquet(kept[3]).columns) == ["_row"]
    assert [spark.read.parquet(kept[i]).count() for i in (0, 1, 2, 3)] == [5, 1, 5, 0]


def test_a_message_is_parsed_once_for_validity_and_moves_as_text(spark, lake):
    texts = ['{"event_id": "a", "event_time": "2024-01-01T00:00:00Z", "city_id": "NYC"}', '{"event_id": "b"}', "[1]", "x", "", None]
    rows = [("t", 0, i, START, 0, "k", text, START, "e") for i, text in enumerate(texts)]
    keyed = with_keys(spark.createDataFrame(rows, schemas.BRONZE))
    for split in (valid_rows, quarantined_rows):
        plan = split(keyed)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
    assert [r["offset"] for r in valid_rows(keyed).collect()] == [0]
    assert sorted(r["offset"] for r in quarantined_rows(keyed).collect()) == [1, 2, 3, 4, 5]
    both = [sorted(map(str, to_canonical(frame).collect())) for frame in (keyed, spark.createDataFrame(rows, schemas.BRONZE))]
    assert both[0] == both[1]
    started = lake.spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with temporarily(spark, spark__sql__maxConcurrentOutputFileWriters=3):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "3"
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == started


def test_history_reaches_the_closed_hours_of_gold(spark, lake):
    lake.publish(*[message(i, f"e{i}", i * 20) for i in range(30)], message(999, "z", 900))
    lake.run()
    silver_root, gold_root = f"{lake.root}/silver", f"{lake.root}/gold"

    def fill(event_id, source, minutes):
        row = read_silver(spark, silver_root).where(F.col("event_id") == source)
        at = F.lit(START + timedelta(minutes=minutes))
        history = row.withColumn("event_id", F.lit(event_id)).withColumn("event_time", at).withColumn("event_date", F.to_date(at))
        # A run that is repeated changes nothing.
        for added in (1, 0):
            assert backfill_silver(spark, history, silver_root) == added
            backfill_gold(spark, history_days(history), silver_root, gold_root)
        rows = read_gold(spark, gold_root).collect()
        assert len(rows) == len({(r["city_id"], r["window_start"]) for r in rows})
        return {(r["window_start"] - START).total_seconds() / 3600: r["completed_trips"] for r in rows}

    assert read_gold(spark, gold_root).count() == 10
    streamed = {float(h): 3 for h in range(10)}
    assert fill("old", "e1", 190) == streamed | {3.0: 4}
    # An hour before all others, one of a day that was filled before, and one that isn't closed yet.
    assert fill("older", "e1", -90) == streamed | {3.0: 4, -2.0: 1}
    assert fill("oldest", "e2", 250) == streamed | {3.0: 4, 4.0: 4, -2.0: 1}
    assert fill("open", "e2", 905) == streamed | {3.0: 4, 4.0: 4, -2.0: 1}
    # The job, once the hour is closed.
    lake.publish(message(1000, "zz", 1200))
    lake.run()
    silver_rows = read_silver(spark, silver_root).where(F.col("event_id") == "open")
    silver_rows.write.parquet(f"{lake.root}/history")
    jobs.main(["backfill", "--input", f"{lake.root}/history", "--silver-root", silver_root, "--gold-root", gold_root], spark)
    found = {(r["window_start"] - START).total_seconds() / 3600: r["completed_trips"] for r in read_gold(spark, gold_root).collect()}
    assert found == streamed | {3.0: 4, 4.0: 4, -2.0: 1, 15.0: 2}


def test_there_are_fifteen_topics_with_distinct_entities():
    assert len(settings.TOPICS) == len(settings.ENTITY_OF_TOPIC) == len(set(settings.ENTITY_OF_TOPIC.values())) == 15
