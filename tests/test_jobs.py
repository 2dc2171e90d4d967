"""The jobs in order, from topics to answers, on one warehouse folder."""

import json
from datetime import datetime, timedelta

import pytest

from tripflow import jobs, schemas
from tripflow.operators import audit
from tripflow.sources.tables import event_messages, table
from tripflow.sources.topics import land_messages


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("platform"))


def test_jobs_from_topics_to_answers(spark, root, capsys):
    events = table(spark, "/root/testdata/sf0.001", "events")
    land_messages(event_messages(events), f"{root}/topics")
    # Topics nothing was sent to exist, but are empty.
    from pathlib import Path

    from tripflow.settings import TOPICS

    for topic in TOPICS:
        Path(f"{root}/topics/topic={topic['name']}").mkdir(exist_ok=True)
    lake, house = root, f"{root}/warehouse"

    def run(*argv):
        jobs.main(list(argv), spark)
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    stream = ["--bounded", "--checkpoint-root"]
    assert run("bronze", "--bronze-root", f"{lake}/bronze", "--files", f"{root}/topics", *stream, f"{lake}/marks/b")["topics"] == 15
    run("silver", "--bronze-root", f"{lake}/bronze", "--silver-root", f"{lake}/silver", *stream, f"{lake}/marks/s", "--state-partitions", "3")
    assert len([p for p in Path(f"{lake}/marks/s/canonical_events/state/0").iterdir() if p.name.isdigit()]) == 3
    run("gold", "--silver-root", f"{lake}/silver", "--gold-root", f"{lake}/gold", *stream, f"{lake}/marks/g")
    run("staging", "--silver-root", f"{lake}/silver", "--warehouse", house)
    run("models", "--warehouse", house)
    before = jobs.Warehouse(spark, house).read("fact_trip").count()
    assert before > 0
    run("models", "--warehouse", house)
    assert jobs.Warehouse(spark, house).read("fact_trip").count() == before
    assert run("features", "--warehouse", house)["target_tables"] == 3
    outcome = run("train", "--warehouse", house, "--artifacts", f"{root}/artifacts", "--models", "demand_model", "churn_model")
    assert outcome["demand_model"]["metric_name"] == "mae"
    run("score", "--warehouse", house, "--artifacts", f"{root}/artifacts", "--models", "demand_model")
    run("stores", "--warehouse", house)
    run("stores", "--warehouse", house)
    run("query", "--warehouse", house, "--sql", "select count(*) as n from {fact_trip} join {dim_city} using (city_key)", "--output", f"{root}/asked")
    assert spark.read.parquet(f"{root}/asked").first()["n"] > 0
    run("inventory", "--warehouse", house, "--output", f"{root}/inventory")
    listed = {r["relation"]: r for r in spark.read.option("header", "true").csv(f"{root}/inventory").collect()}
    stores = [f"store_{name}" for name in jobs.STORES]
    assert {"staging", "fact_trip", "feature_fraud_trip", "scores_demand_model", "run_log", *stores} <= set(listed)
    assert "document_index" not in listed and "scores_fraud_model" not in listed
    for name in stores:
        # Written twice; only what is in use counts.
        table_ = jobs.Warehouse(spark, house).keyed(name)
        assert not list(Path(f"{table_.root}/changes").iterdir())
        held = sum(p.stat().st_size for p in Path(table_.path).glob("**/*.parquet"))
        assert int(listed[name]["size_bytes"]) == held

    corpus = [("faq", "faq", "faq", "NYC", "d1", "how do refunds work"), ("faq", "faq", "faq", "SF", "d2", "surge pricing explained"), ("faq", "faq", "faq", "SF", "d3", "")]
    spark.createDataFrame(corpus, "source_id string, target_table string, source_type string, city_id string, doc_id string, text string").write.parquet(f"{root}/corpus")
    assert run("index", "--warehouse", house, "--input", f"{root}/corpus")["indexed_docs_total"] == 2
    assert run("index", "--warehouse", house, "--input", f"{root}/corpus")["indexed_docs_total"] == 2
    spark.createDataFrame([("q1", "refunds how")], "question_id string, question string").write.json(f"{root}/questions")
    run("ask", "--warehouse", house, "--input", f"{root}/questions", "--output", f"{root}/answers", "--top-k", "1")
    assert "how do refunds work" in spark.read.json(f"{root}/answers").first()["answer"]

    # The events are long past, so freshness fails and the run is logged as failed.
    with pytest.raises(Exception, match="kpi_table_freshness"):
        jobs.main(["quality", "--warehouse", house], spark)
    log = spark.read.schema(schemas.RUN_EVENT).parquet(f"{house}/run_log")
    states = {(r["pipeline_name"], r["status"]) for r in audit.current_runs(log).collect()}
    assert ("models", "success") in states and ("quality", "failed") in states
    assert not any(status == "running" for _, status in states)


def test_open_data_job_appends_and_keeps_the_last(spark, tmp_path, capsys):
    start = datetime(2024, 1, 1, 9)
    rows = [(f"t{i}", start + timedelta(days=i % 2), start + timedelta(days=i % 2, minutes=10), 5.0) for i in range(4)]
    source = spark.createDataFrame(rows, "trip_id string, trip_start_timestamp timestamp, trip_end_timestamp timestamp, fare double")
    source.write.parquet(str(tmp_path / "in.parquet"))
    source.write.option("header", "true").csv(str(tmp_path / "in.csv"))
    common = ["open-data", "--city-id", "CHICAGO", "--output", str(tmp_path / "out")]
    jobs.main([*common, "--input", str(tmp_path / "in.parquet"), "--for-date", "2024-01-01", "--append"], spark)
    table_ = jobs.SnapshotTable(spark, str(tmp_path / "out"))
    assert table_.read().count() == 2
    jobs.main([*common, "--input", str(tmp_path / "in.csv"), "--append"], spark)
    assert table_.read().count() == 4
