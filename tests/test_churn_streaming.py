"""Churn model on a planted-signal fixture; streaming intake replay."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.operators import churn
from growlytics.streaming import intake

P = Params()


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(42)
    rows = []
    for i in range(600):
        churned = int(rng.random() < 0.35)
        recency = rng.randint(60, 200) if churned else rng.randint(0, 40)
        rows.append((f"U{i}", rng.choice(["Pro", "Enterprise"]), rng.choice(["Google", "Meta", "Organic"]),
                     rng.randint(1, 50), recency, rng.choice(["Desktop", "Mobile", "Tablet"]),
                     rng.randint(0, 9), rng.randint(0, 20), rng.randint(0, 60), float(rng.randint(0, 900)), churned))
    schema = ("user_id string, plan string, channel string, session_count bigint, recency bigint, device_type string, "
              "search_count bigint, pv_count bigint, total_events bigint, total_revenue double, churned int")
    return spark.createDataFrame(rows, schema)


def test_forest_learns_planted_signal(spark, planted):
    train, test = churn.split(planted, P)
    n_test = test.count()
    assert 0.1 * 600 < n_test < 0.3 * 600
    model = churn.fit(train, P)
    scored = churn.score(model, test)
    probs = [r["churn_probability"] for r in scored.collect()]
    assert all(0.0 <= x <= 1.0 for x in probs)
    m = {r["class"]: r for r in churn.evaluate(scored).collect()}
    assert m[1]["accuracy"] > 0.9 and m[1]["recall"] > 0.8
    imp = churn.importances(spark, model).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)
    assert imp[0]["feature"] == "recency"
    # reproducible: same seed, same probabilities
    again = [r["churn_probability"] for r in churn.score(churn.fit(train, P), test).collect()]
    assert again == probs


def test_unseen_category_and_persistence(spark, planted, tmp_path):
    train, _ = churn.split(planted, P)
    model = churn.fit(train, P)
    row = planted.limit(1).withColumn("device_type", F.lit("Smartwatch")).withColumn("plan", F.lit("Gold"))
    p1 = churn.score(model, row).first()["churn_probability"]
    as_zero = planted.limit(1).withColumn("device_type", F.lit("Desktop")).withColumn("plan", F.lit("Enterprise"))
    assert p1 == pytest.approx(churn.score(model, as_zero).first()["churn_probability"])  # code 0 = first label
    path = str(tmp_path / "model")
    churn.save(model, path)
    loaded = churn.load(path)
    assert churn.score(loaded, row).first()["churn_probability"] == pytest.approx(p1)


def test_too_few_rows_gives_rule_fallback(spark, planted):
    assert churn.fit(planted.limit(10), P) is None
    imp = churn.importances(spark, None).collect()
    assert imp[0]["feature"] == "recency" and imp[0]["importance"] == 0.40


def test_rule_score_payload(spark):
    # FIXTURES.md section 3 payload: recency 2, Desktop -> 0.15
    df = spark.createDataFrame([(2, "Desktop"), (95, "Mobile"), (31, "Tablet"), (200, "Mobile")],
                               "recency int, device_type string")
    got = [round(r[0], 10) for r in df.select(churn.rule_score()).collect()]
    assert got == [0.15, 0.85, 0.4, 0.85]


def test_stream_intake_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="growlytics-stream-")
    landing, sink, ckpt = (os.path.join(base, x) for x in ("landing", "sink", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as fh:
        fh.write('{"event_id": "EVT_1", "user_id": "USR_1", "event_type": "page_view", "event_time": "2026-06-01 10:00:00"}\n')
        fh.write('{"user_id": "USR_999999", "event_type": "page_view"}\n')
    intake.run_available(spark, landing, sink, ckpt)
    first = spark.read.parquet(sink)
    assert first.count() == 2
    gen = first.where("user_id = 'USR_999999'").first()
    assert gen["event_id"].startswith("EVT_") and len(gen["event_id"]) == 36 and gen["event_time"] is not None
    # restart on the same checkpoint: nothing new
    intake.run_available(spark, landing, sink, ckpt)
    assert spark.read.parquet(sink).count() == 2
    # a replayed payload (same event_id) in a new file is dropped
    with open(os.path.join(landing, "b.json"), "w") as fh:
        fh.write('{"event_id": "EVT_1", "user_id": "USR_1", "event_type": "page_view", "event_time": "2026-06-01 10:00:00"}\n')
        fh.write('{"event_id": "EVT_2", "user_id": "USR_2", "event_type": "login", "event_time": "2020-01-01 00:00:00"}\n')
    intake.run_available(spark, landing, sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.count() == 3
    # old event times are accepted (watermark is on arrival time)
    assert out.where("event_id = 'EVT_2'").first()["date_id"] == 20200101


def test_equal_payloads_without_id_all_stay(spark):
    base = tempfile.mkdtemp(prefix="growlytics-stream-")
    landing, sink, ckpt = (os.path.join(base, x) for x in ("landing", "sink", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as fh:
        fh.write('{"user_id": "USR_1", "event_type": "page_view"}\n' * 5)
        fh.write('{"user_id": "USR_2", "event_type": "login", "event_time": "not a time"}\n')
    for _ in range(2):  # a restart adds none
        intake.run_available(spark, landing, sink, ckpt)
        rows = spark.read.parquet(sink).collect()
        assert len(rows) == 6 and len({r["event_id"] for r in rows}) == 6 and all(r["event_time"] for r in rows)


def test_tight_split_keeps_class_proportions(spark, planted):
    train, test = churn.split(planted, P, tight=True)
    by = {r["churned"]: r["count"] for r in test.groupBy("churned").count().collect()}
    tot = {r["churned"]: r["count"] for r in planted.groupBy("churned").count().collect()}
    for k in tot:
        assert abs(by[k] / tot[k] - 0.2) < 0.02
    assert train.count() + test.count() == planted.count()


def test_leak_free_features_cut_activity(spark):
    from growlytics.sources.warehouse import Warehouse

    p = Params.binding()
    wh = Warehouse.from_binding(spark, "/root/testdata/sf0.001")
    coded = {r["user_id"]: r for r in churn.features(wh, p).collect()}
    cut = {r["user_id"]: r for r in churn.features(wh, p, leak_free=True).collect()}
    assert set(coded) == set(cut)
    assert all(cut[u]["session_count"] <= coded[u]["session_count"] for u in coded)
    assert all(cut[u]["total_revenue"] <= coded[u]["total_revenue"] + 1e-9 for u in coded)


def test_stream_processing_time_trigger(spark):
    base = tempfile.mkdtemp(prefix="growlytics-stream-")
    landing, sink, ckpt = (os.path.join(base, x) for x in ("landing", "sink", "ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "a.json"), "w") as fh:
        fh.write('{"event_id": "EVT_9", "user_id": "USR_9", "event_type": "search", "event_time": "2026-06-02 08:00:00"}\n')
    q = intake.start(intake.intake(spark, landing), sink, ckpt, available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(sink).count() == 1
