"""Operators against plain Python on small inputs."""

import hashlib
import math
import random
import uuid
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.functions import coerce, keys
from tripflow.operators import audit, dedup, embeddings, quality, retrieval, skew, timeline, upsert
from tripflow.operators.conform import conform
from tripflow.plans import checks, dimensions, features, models, monitoring, opendata
from tripflow import schemas


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


# Expressions -------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, value", [("1.50", 1.5), ("", None), ("x", None), (" 2 ", 2.0), (None, None), ("1e3", 1000.0)]
)
def test_to_double(spark, text, value):
    assert one(spark, text, "string", coerce.to_double) == value


@pytest.mark.parametrize(
    "text", ["2026-06-17T10:00:00Z", "2026-06-17T10:00:00+00:00", "2026-06-17T12:00:00+02:00", "2026-06-17 10:00:00"]
)
def test_to_time(spark, text):
    assert one(spark, text, "string", coerce.to_time) == datetime(2026, 6, 17, 10)


def test_to_time_rejects_text(spark):
    assert one(spark, "soon", "string", coerce.to_time) is None


@pytest.mark.parametrize(
    "number, text", [(0.0, "0"), (5.0, "5"), (2.5, "2.5"), (1e7, "10000000"), (100.0, "100"), (-1.25, "-1.25")]
)
def test_number_text(spark, number, text):
    assert one(spark, number, "double", keys.number_text) == text


def test_name_uuid_is_version_five(spark):
    names = [f"source::{i}" for i in range(300)] + ["döcument::ü", ""]
    frame = spark.createDataFrame([(n,) for n in names], "v string")
    for name, made in frame.select("v", keys.name_uuid(F.col("v"))).collect():
        assert made == str(uuid.uuid5(uuid.NAMESPACE_DNS, name))


# Deduplication and merges --------------------------------------------------------


def test_keep_last_survives_one_key_with_most_rows(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("n"),
    )
    kept = dedup.keep_last(rows, ["k"], ["n"])
    assert kept.filter("k = 'hot'").first()["n"] == 199_998
    assert kept.count() == rows.select("k").distinct().count()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keep_first_follows_arrival(spark):
    rows = spark.createDataFrame(
        [("a", 0, 5), ("a", 0, 2), ("b", 1, 1), ("", 0, 0), (None, 0, 1)],
        "event_id string, partition int, offset bigint",
    )
    first = {r["event_id"]: r["offset"] for r in dedup.first_arrivals(rows).collect()}
    assert first == {"a": 2, "b": 1}


def test_deduplication_is_idempotent(spark):
    rows = spark.range(1000).select((F.col("id") % 70).alias("k"), F.col("id").alias("n"))
    once = dedup.keep_last(rows, ["k"], ["n"])
    twice = dedup.keep_last(once, ["k"], ["n"])
    assert sorted(once.collect()) == sorted(twice.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def test_replace_by_key(spark):
    old, new = frame(spark, [("a", 1), ("b", 2)]), frame(spark, [("b", 3), ("b", 4), ("c", 5)])
    merged = upsert.replace_by_key(old, new, ["k"])
    assert sorted(merged.collect()) == [("a", 1), ("b", 3), ("b", 4), ("c", 5)]
    assert sorted(upsert.replace_by_key(merged, new, ["k"]).collect()) == sorted(merged.collect())


def test_replace_by_key_accepts_new_columns(spark):
    old = frame(spark, [("a", 1)])
    new = spark.createDataFrame([("b", 2, "x")], "k string, v int, w string")
    assert sorted(upsert.replace_by_key(old, new, ["k"]).collect(), key=str) == [("a", 1, None), ("b", 2, "x")]


def test_insert_if_absent(spark):
    old, new = frame(spark, [("a", 1)]), frame(spark, [("a", 9), ("b", 2)])
    assert sorted(upsert.insert_if_absent(old, new, ["k"]).collect()) == [("a", 1), ("b", 2)]


def test_merge_fields_keeps_what_is_not_carried(spark):
    old = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, p string, q int")
    new = spark.createDataFrame([("b", 7, True), ("c", 8, False)], "k string, q int, r boolean")
    merged = {r["k"]: r.asDict() for r in upsert.merge_fields(old, new, ["k"]).collect()}
    assert merged["a"] == {"k": "a", "p": "x", "q": 1, "r": None}
    assert merged["b"] == {"k": "b", "p": "y", "q": 7, "r": True}
    assert merged["c"] == {"k": "c", "p": None, "q": 8, "r": False}


def test_replace_prefix_keeps_null(spark):
    old, new = frame(spark, [("x-1", 1), (None, 2), ("y", 3)]), frame(spark, [("x-2", 4)])
    kept = upsert.replace_prefix(old, new, "k", "x-").collect()
    assert sorted(kept, key=str) == [("x-2", 4), ("y", 3), (None, 2)]


def test_append_keep_last_prefers_incoming(spark):
    old, new = frame(spark, [("a", 1), ("b", 2)]), frame(spark, [("b", 3)])
    assert sorted(upsert.append_keep_last(old, new, ["k"]).collect()) == [("a", 1), ("b", 3)]


def test_conform_fills_and_coerces(spark):
    raw = spark.createDataFrame([("e", "12.5", "7", "bad")], "event_id string, fare_total string, requested_trips string, event_time string")
    row = conform(raw, schemas.STAGING).first()
    assert (row["fare_total"], row["requested_trips"], row["event_time"], row["trip_id"]) == (12.5, 7, None, None)
    assert row.__fields__ == schemas.STAGING.fieldNames()


# Long histories ------------------------------------------------------------------


def random_history(seed, keys_, values, count, span_hours=40):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        (
            # One key holds a third of all rows.
            "hot" if rng.random() < 0.34 else rng.choice(keys_), rng.choice(values),
            start + timedelta(minutes=rng.randrange(span_hours * 60)), f"e{i:05d}",
        )
        for i in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_value_periods_equal_a_plain_scan(spark, seed):
    rows = random_history(seed, ["a", "b"], ["x", "y", None], 300)
    wanted = []
    for key in {r[0] for r in rows}:
        history = sorted([(r[2], r[3], r[1]) for r in rows if r[0] == key], key=lambda r: r[:2])
        starts = [h for i, h in enumerate(history) if i == 0 or history[i - 1][2] != h[2]]
        for i, (at, _, value) in enumerate(starts):
            wanted.append((key, value, at, starts[i + 1][0] if i + 1 < len(starts) else None))
    frame_ = spark.createDataFrame(rows, "k string, v string, t timestamp, e string")
    got = timeline.value_periods(frame_, "k", "v", "t", "e").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, wanted))


@pytest.mark.parametrize("seed", [4, 5])
def test_running_before_equals_a_plain_scan(spark, seed):
    rows = random_history(seed, ["a", "b", "c"], [1, 2, 5], 250)
    frame_ = spark.createDataFrame(rows, "k string, v bigint, t timestamp, e string")
    got = {r["e"]: r["s"] for r in timeline.running_before(frame_, "k", "t", {"s": "v"}).collect()}
    for key, value, at, event in rows:
        assert got[event] == sum(r[1] for r in rows if r[0] == key and r[2] < at)


def test_a_key_with_a_third_of_the_rows_spreads_over_pieces(spark):
    """No piece holds over twice the mean, and the scans over them are those of one piece."""
    rows = spark.range(60_000).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('k', id % 500) end as k", "cast(id % 7 as bigint) as v",
        "timestamp_seconds(1704067200 + cast(id * 2654435761 % 86400 as bigint)) as t", "cast(id as string) as e",
        "if(id % 5 = 0, null, cast(id % 3 as string)) as c",
    )
    kept = {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}

    def results():
        sums = timeline.running_before(rows, "k", "t", {"s": "v", "n": "v"}).select("e", "s")
        return Counter(map(tuple, sums.collect())), Counter(map(tuple, timeline.value_periods(rows, "k", "c", "t", "e").collect()))

    try:
        for n, value in zip(kept, ("24", "false")):
            spark.conf.set(n, value)
        pieces = timeline.in_pieces(rows, "k", "t")
        sizes = [r["count"] for r in pieces.groupBy("_piece").count().collect()]
        assert len(sizes) >= 20 and max(sizes) <= 2 * sum(sizes) / len(sizes)
        assert pieces.filter("k = 'hot'").select("_piece").distinct().count() >= 7
        spread = results()
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert results() == spread
    finally:
        for n, value in kept.items():
            spark.conf.set(n, value)


@pytest.mark.parametrize("left_hot, right_hot", [(1000, 2), (2, 1000), (150, 150), (1000, 0), (0, 1000), (1, 1)])
def test_grid_join_equals_plain_join(spark, left_hot, right_hot):
    def side(hot, column):
        # Hot key, a key on either side, keys on one side, NULLs.
        rows = [("hot", i) for i in range(hot)] + [(f"k{i % 40}", 10_000 + i) for i in range(120)]
        rows += [(f"{column}{i}", 20_000 + i) for i in range(30)] + [(None, 30_000 + i) for i in range(50)]
        return spark.createDataFrame(rows, f"k string, {column} bigint")

    left, right = side(left_hot, "v"), side(right_hot, "w")
    joined = skew.grid_left_join(left, right, "k", ["v"], ["w"], salts=4, share=0.2)
    plain = left.join(right, "k", "left")
    pick = lambda f: sorted(map(str, f.select("k", "v", "w").collect()))
    assert pick(joined) == pick(plain)


# Rules ---------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [7, 8])
def test_lifecycle_breaks_equal_a_pairwise_check(spark, staging, seed):
    rng = random.Random(seed)
    states = ["ride_requested", "driver_assigned", "trip_started", "trip_completed"]
    rows = [
        {"event_id": f"e{i}", "trip_id": f"t{rng.randrange(30)}", "event_type": rng.choice(states + ["other"]),
         "event_time": datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(50)), "city_id": "NYC"}
        for i in range(150)
    ]
    broken = defaultdict(set)
    for late in rows:
        for early in rows:
            if late["trip_id"] == early["trip_id"] and late["event_type"] in states and early["event_type"] in states:
                if states.index(early["event_type"]) < states.index(late["event_type"]) and early["event_time"] > late["event_time"]:
                    # The later state was entered although an earlier one still followed.
                    broken[late["trip_id"]].add(late["event_type"])
    got = {r["trip_id"]: r for r in checks.lifecycle_breaks(staging(*rows), states).collect()}
    assert {t: r["breaks"] for t, r in got.items()} == {t: len(s) for t, s in broken.items()}
    for trip, found in broken.items():
        assert got[trip]["first_break"] == min(found, key=states.index)


def test_quality_rules_fail_on_an_empty_mart(spark, staging):
    from tripflow.plans import gold

    results = quality.kpi_checks(gold.city_daily_kpis(staging()), "r", date(2024, 1, 2), datetime(2024, 1, 2))
    assert {r["rule_id"]: r["violation_count"] for r in results.collect()} == {
        "kpi_table_not_empty": 1, "kpi_table_freshness": 1, "kpi_negative_fares": 0,
    }
    with pytest.raises(quality.QualityFailure):
        quality.require_pass(results)


@pytest.mark.parametrize("day, fresh", [(2, 0), (3, 0), (4, 1)])
def test_freshness_counts_back_from_the_given_day(staging, day, fresh):
    from tripflow.plans import gold

    mart = gold.city_daily_kpis(staging({"event_id": "a", "city_id": "NYC", "event_time": "2024-01-02T10:00:00", "fare_total": -1.0}))
    results = quality.kpi_checks(mart, "r", date(2024, 1, day), datetime(2024, 1, 5))
    found = {r["rule_id"]: r["violation_count"] for r in results.collect()}
    assert found["kpi_table_freshness"] == fresh
    assert found["kpi_negative_fares"] == 1


def test_run_restart_resets_state_and_details(spark):
    at = lambda m: datetime(2024, 1, 1, 0, m)
    log = spark.createDataFrame(
        [
            ("r1", "p", "s", "running", at(0), '{"a": 1, "b": "x"}'),
            ("r1", "p", "s", "failed", at(5), '{"b": "y", "c": 2.5}'),
            ("r2", "p", "s", "running", at(0), '{"old": 1}'),
            ("r2", "p", "s", "failed", at(3), '{"gone": 1}'),
            ("r2", "q", "s", "running", at(7), '{"new": 1}'),
            ("r3", "p", "s", "running", at(1), "{}"),
            ("r3", "p", "s", "skipped", at(1), '{"reason": "off"}'),
        ],
        schemas.RUN_EVENT,
    )
    runs = {r["run_id"]: r for r in audit.current_runs(log).collect()}
    assert runs["r1"]["details"] == '{"a":"1","b":"y","c":"2.5"}'
    assert (runs["r1"]["status"], runs["r1"]["ended_at"]) == ("failed", at(5))
    assert runs["r2"]["details"] == '{"new":"1"}'
    assert (runs["r2"]["status"], runs["r2"]["ended_at"], runs["r2"]["started_at"]) == ("running", None, at(7))
    assert runs["r2"]["pipeline_name"] == "q"
    assert (runs["r3"]["status"], runs["r3"]["ended_at"]) == ("skipped", at(1))


def test_dimension_of_a_busy_rider(staging):
    rows = [
        {"event_id": f"e{i}", "rider_id": "r", "city_id": "NYC" if i % 2 else "SF",
         "event_time": datetime(2024, 1, 2 + i % 5)} for i in range(40)
    ]
    found = dimensions.dim_rider(staging(*rows), datetime(2024, 2, 1)).collect()
    assert len(found) == 2
    assert {r["signup_date"] for r in found} == {date(2024, 1, 2)}


def test_promotion_of_zero_and_of_nothing_is_one(staging):
    at = {"event_time": "2024-01-01T00:00:00", "city_id": "NYC"}
    rows = staging({"event_id": "a", "promotion_amount": None, **at}, {"event_id": "b", "promotion_amount": 0.0, **at}, {"event_id": "c", "promotion_amount": 2.5, **at})
    found = {r["promotion_id"]: r["cap_amount"] for r in dimensions.dim_promotion(rows).collect()}
    assert found == {"promo_0": 0.0, "promo_2.5": 2.5}


def test_churn_label_marks_riders_who_come_back_late(staging):
    from tripflow.plans import facts

    rows = [
        {"event_id": f"e{i}", "trip_id": f"t{i}", "rider_id": rider, "city_id": "NYC", "event_time": datetime(2026, 4, day)}
        for i, (rider, day) in enumerate([("late", 1), ("late", 20), ("steady", 1), ("steady", 8)])
    ]
    churn = features.rider_churn_daily(facts.fact("fact_trip", staging(*rows)))
    late, steady = (hashlib.md5(n.encode()).hexdigest() for n in ("late", "steady"))
    got = {(r["rider_key"], r["activity_date"].day): r["churned_7d"] for r in churn.collect()}
    assert got == {(late, 1): 1, (late, 20): 0, (steady, 1): 0, (steady, 8): 0}


# Open data -------------------------------------------------------------------------


def test_nyc_trip_ids_and_money(spark):
    source = spark.createDataFrame(
        [(2, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 10), 7, 9, "3.5", 20.0, 1), (1, datetime(2024, 1, 1, 5), None, 7, 9, "bad", None, None)],
        "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, PULocationID int, DOLocationID int, trip_distance string, total_amount double, payment_type int",
    )
    rows = {r["trip_id"]: r for r in opendata.normalize(source, opendata.NYC).collect()}
    trip = rows["nyc_2_2024-01-01 00:00:00_7_9"]
    assert trip["event_id"] == hashlib.sha256(b"evt_nyc_2_2024-01-01 00:00:00_7_9").hexdigest()
    assert trip["rider_id"] == hashlib.sha256(b"nyc_rider_7_9_2024-01-01 00:00:00").hexdigest()
    assert trip["driver_id"] == hashlib.sha256(b"nyc_driver_2").hexdigest()
    assert (trip["distance_km"], trip["duration_sec"]) == (3.5 * 1.60934, 600.0)
    assert (trip["platform_fee"], trip["driver_payout"]) == (4.0, 16.0)
    other = rows["nyc_1_2024-01-01 05:00:00_7_9"]
    assert (other["distance_km"], other["duration_sec"], other["fare_total"]) == (0.0, 0.0, None)


def test_missing_source_columns_get_defaults(spark):
    source = spark.createDataFrame([("t1", "2024-01-01T00:00:00", "2024-01-01T00:10:00")], "trip_id string, trip_start_timestamp string, trip_end_timestamp string")
    row = opendata.normalize(source, opendata.CHICAGO).first()
    assert (row["fare_total"], row["distance_km"], row["pickup_lat"], row["payment_method_code"]) == (0.0, 0.0, None, "unknown")
    assert row["driver_id"] == hashlib.sha256(b"chi_driver_unknown").hexdigest()
    assert row["event_time"] == datetime(2024, 1, 1, 0, 10)


def test_city_batches_obey_the_contract(spark):
    with pytest.raises(ValueError, match="no open-data mapping"):
        opendata.city_batch(spark.range(1), "PARIS")
    source = spark.createDataFrame(
        [("t1", datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 10), -5.0), ("t2", datetime(2024, 1, 2), datetime(2024, 1, 2, 0, 10), 5.0)],
        "trip_id string, trip_start_timestamp timestamp, trip_end_timestamp timestamp, fare double",
    )
    with pytest.raises(Exception, match="negative"):
        opendata.city_batch(source, "chicago")
    assert opendata.city_batch(source, "chicago", for_date="2024-01-02").count() == 1


def test_enabled_cities():
    assert opendata.enabled_cities() == ["NYC", "CHICAGO"]
    assert opendata.enabled_cities([{"city_id": "SF", "enabled": True, "open_data": "pending"}]) == ["NYC", "CHICAGO"]
    assert opendata.enabled_cities([{"city_id": "nyc", "enabled": True, "open_data": "nyc_tlc"}]) == ["NYC"]


# Vectors -----------------------------------------------------------------------------

TEXTS = [
    "The cat sat on the mat", "", "   ", "Ünïcode Straße no　break ΣΊΣΥΦΟΣ", "one\ttwo\n two THREE", "a a a a",
    "x" * 5000, " ".join(f"w{i % 97}" for i in range(3000)),
]


def python_embedding(text, dim=256):
    vec = [0.0] * dim
    for token in text.lower().split():
        h = int(hashlib.sha256(token.encode()).hexdigest(), 16)
        vec[h % dim] += -1.0 if (h >> 1) & 1 else 1.0
    size = math.sqrt(sum(v * v for v in vec))
    return [v / size for v in vec] if size else vec


@pytest.mark.parametrize("dim", [64, 256])
def test_hash_vectors_equal_the_formula(spark, dim):
    documents = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    made = {r["id"]: r["vector"] for r in embeddings.hash_vectors(documents, "id", "text", dim).collect()}
    assert len(made) == len(TEXTS)
    for number, text in enumerate(TEXTS):
        assert made[number] == python_embedding(text, dim)


def brute_force(docs, asked, k):
    result = {}
    for q, qv in asked:
        scored = []
        for d, dv in docs:
            size = np.linalg.norm(qv) * np.linalg.norm(dv)
            far = 1.0 - (float(np.dot(qv, dv)) / size if size else 0.0)
            scored.append((round(far, 6) + 0.0, d))
        result[q] = [d for _, d in sorted(scored)[:k]]
    return result


def test_a_document_sends_one_row_and_texts_of_one_key_add_up(spark):
    rows = [(1, "a b"), (1, "A c"), (None, "d"), (None, " d"), (2, ""), (3, None), (4, "b b e")]
    documents = spark.createDataFrame(rows, "id int, text string").repartition(3)
    made = embeddings.hash_vectors(documents, "id", "text", 16)
    assert "Generate" not in made._jdf.queryExecution().optimizedPlan().toString()
    joined = spark.createDataFrame([(1, "a b a c"), (5, "d d"), (2, ""), (4, "b b e")], "id int, text string")
    wanted = {r["id"]: r["vector"] for r in embeddings.hash_vectors(joined, "id", "text", 16).collect()}
    found = {r["id"]: r["vector"] for r in made.collect()}
    assert found == {1: wanted[1], None: wanted[5], 2: [0.0] * 16, 3: [0.0] * 16, 4: wanted[4]}
    cells = {(r["id"], r["idx"]): r["weight"] for r in embeddings.hashed_cells(documents, "id", "text", 16).collect()}
    length = sum(w * w for (key, _), w in cells.items() if key == 1) ** 0.5
    assert [cells.get((1, i), 0) / length for i in range(16)] == found[1]
    assert {key for key, _ in cells} == {1, None, 4}


@pytest.mark.parametrize("block_bytes", [64 * 1024 * 1024, 2000])
def test_nearest_equals_brute_force(spark, block_bytes):
    rng = np.random.default_rng(3)
    docs = [(f"d{i:03d}", rng.integers(-3, 4, 16).astype(float).tolist()) for i in range(200)]
    docs += [(f"c{i:03d}", docs[i][1]) for i in range(40)] + [("zero", [0.0] * 16)]
    asked = [(i, rng.integers(-3, 4, 16).astype(float).tolist()) for i in range(30)]
    documents = spark.createDataFrame(docs, "doc string, vector array<double>").repartition(5)
    questions = spark.createDataFrame(asked, "q int, vector array<double>")
    hits = retrieval.nearest(documents, questions, "doc", "q", 4, 16, block_bytes).collect()
    got = defaultdict(dict)
    for r in hits:
        got[r["q"]][r["rank"]] = r["doc"]
    wanted = brute_force(docs, asked, 4)
    assert {q: [ranks[i] for i in range(1, 5)] for q, ranks in got.items()} == wanted


def test_nearest_of_few_and_of_none(spark):
    documents = spark.createDataFrame([("a", [1.0, 0.0])], "doc string, vector array<double>")
    questions = spark.createDataFrame([(1, [1.0, 1.0])], "q int, vector array<double>")
    assert [tuple(r) for r in retrieval.nearest(documents, questions, "doc", "q", 3, 2).collect()] == [(1, "a", 0.292893, 1)]
    assert retrieval.nearest(documents, questions.limit(0), "doc", "q", 3, 2).count() == 0
    assert retrieval.nearest(documents.limit(0), questions, "doc", "q", 3, 2).count() == 0
    with pytest.raises(ValueError):
        retrieval.nearest(documents, questions, "doc", "q", 21)


def test_vectors_that_do_not_fit_are_an_error(spark):
    """None vanishes from the result without a word."""
    good = spark.createDataFrame([("a", [1.0, 0.0])], "doc string, vector array<double>")
    asked = good.select(F.col("doc").alias("q"), "vector")
    for bad in ([1.0], None):
        wrong = spark.createDataFrame([("b", bad)], "doc string, vector array<double>")
        with pytest.raises(ValueError, match="1 questions without"):
            retrieval.nearest(good, asked.union(wrong), "doc", "q", 3, 2)
        with pytest.raises(Exception, match="1 documents without"):
            retrieval.nearest(good.union(wrong), asked, "doc", "q", 3, 2).collect()


def test_answers_without_context(spark):
    questions = spark.createDataFrame([(1, "why?"), (2, "how?")], "question_id int, question string")
    hits = spark.createDataFrame(
        [(1, 2, "d2", "s", "faq", "NYC", 0.4, "later"), (1, 1, "d1", "s", "faq", None, 0.1, "because")],
        "question_id int, rank int, doc_id string, source_id string, source_type string, city_id string, distance double, text string",
    )
    found = {r["question_id"]: r for r in retrieval.answers(questions, hits).collect()}
    assert found[1]["answer"].endswith("- Most relevant source: s [faq]\n- Evidence: because")
    assert found[1]["sources"].startswith('[{"docId":"d1"')
    assert (found[2]["answer"], found[2]["retrieved_count"], found[2]["sources"]) == (retrieval.NO_ANSWER, 0, "[]")
    prompts = {r["question_id"]: r["prompt"] for r in retrieval.prompts(questions, hits).collect()}
    assert "[1] source=s type=faq city=None\ntext=because\n\n[2] source=s" in prompts[1]
    assert retrieval.NO_CONTEXT in prompts[2]


# Monitoring ------------------------------------------------------------------------------


def test_error_alert_needs_the_whole_hold(spark):
    start = datetime(2024, 1, 1)
    # Errors in minutes 0-9 only.
    rows = [(start + timedelta(minutes=m), "/x", "GET", 500 if m < 10 else 200, 0.1) for m in range(30)]
    log = spark.createDataFrame(rows, "ts timestamp, endpoint string, method string, status int, latency_seconds double")
    windows = monitoring.error_ratio(log)
    above = {r["window_end"] for r in windows.filter("above").collect()}
    fires = {r["fires_at"] for r in monitoring.held_alerts(windows, 5).collect()}
    minute = timedelta(minutes=1)
    assert fires == {end for end in above if all(end - i * minute in above for i in range(6))}
    assert fires


def test_latency_quantile_interpolates_in_its_bucket(spark):
    start = datetime(2024, 1, 1)
    rows = [(start, "/x", "GET", 200, 0.02)] * 90 + [(start, "/x", "GET", 200, 2.0)] * 10
    log = spark.createDataFrame(rows, "ts timestamp, endpoint string, method string, status int, latency_seconds double")
    row = monitoring.latency_p95(log).first()
    assert row["p95_seconds"] == 1.0 + 1.5 * (95 - 90) / 10
    assert row["above"]


# Models ----------------------------------------------------------------------------------


def test_training_without_data_or_classes_is_skipped(spark):
    empty = spark.createDataFrame([], "rider_key string, activity_date date, trip_events bigint, churned_7d int")
    model, outcome = models.train(empty, "churn_model")
    assert model is None and outcome["note"] == "no training data"
    same = spark.createDataFrame([("a", date(2024, 1, 1), 3, 0)], empty.schema)
    assert models.train(same, "churn_model")[1]["note"] == "insufficient class diversity"


def test_score_fills_missing_features_with_zero(spark, tmp_path):
    rows = [(f"r{i}", date(2024, 1, 1), i % 10, int(i % 10 > 4)) for i in range(200)]
    churn = spark.createDataFrame(rows, "rider_key string, activity_date date, trip_events bigint, churned_7d int")
    model, outcome = models.train(churn, "churn_model", trees=10)
    assert outcome["metric_value"] > 0.95
    models.save(model, str(tmp_path / "churn"))
    loaded = models.load(str(tmp_path / "churn"))
    scored = models.score(loaded, spark.createDataFrame([("x", None), ("y", 9)], "rider_key string, trip_events bigint"), "churn_model")
    found = {r["rider_key"]: (r["prediction"], r["probability"] >= 0.5) for r in scored.collect()}
    assert found == {"x": (0, False), "y": (1, True)}
