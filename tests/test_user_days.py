"""The user-day mart against the facts it is made of."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from growlytics.config import Params
from growlytics.operators import churn, user_days as U
from growlytics.sources.warehouse import Warehouse, bucket_count
from tests.conftest import SMOKE

P = Params.binding()


@pytest.fixture(scope="module")
def facts(spark):
    t = dt.datetime
    s = spark.createDataFrame([
        (1, "u", t(2001, 1, 1, 9), "Mobile"), (1, "u", t(2001, 1, 3, 9), "Tablet"),  # one id on two days
        (2, "u", t(2001, 1, 3, 23, 59), "Desktop"), (None, "u", t(2001, 1, 4), None), (3, "v", None, "Mobile"),
        (4, None, t(2001, 1, 1), "Mobile"), (1, "v", t(2001, 1, 2), "Mobile")],
        "session_id long, user_id string, session_start timestamp, device_type string")
    e = spark.createDataFrame([(1, "u", "click", t(2001, 1, 1)), (None, "u", "view", t(2001, 1, 1)), (3, "w", "view", t(2001, 1, 9)), (4, "u", None, t(2001, 1, 1))],
                              "event_id long, user_id string, event_type string, event_time timestamp")
    p = spark.createDataFrame([(1, "u", 2.5, dt.date(2001, 1, 1)), (2, "u", None, dt.date(2001, 1, 1)), (3, "x", 1.0, None)],
                              "payment_id long, user_id string, amount double, payment_date date").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    return s, e, p


def test_states_of_each_day(facts):
    got = {(r.user_id, str(r.day)): r for r in U.user_days(*facts, P).collect()}
    assert set(got) == {("u", "2001-01-01"), ("u", "2001-01-03"), ("u", "2001-01-04"), ("v", "None"), ("v", "2001-01-02"), ("w", "2001-01-09"), ("x", "None")}
    first = got["u", "2001-01-01"]
    assert (first.session_rows, first.sessions, first.event_ids, first.searches, first.page_views, first.payments, float(first.amount)) == (1, 1, 2, 1, 1, 2, 2.5)
    assert (got["u", "2001-01-03"].session_rows, got["u", "2001-01-03"].sessions, got["u", "2001-01-03"].device_type) == (2, 1, "Tablet")
    assert got["u", "2001-01-04"].session_rows == 1 and not got["u", "2001-01-04"].sessions


def test_merged_states_equal_the_facts(facts):
    s, _, _ = facts
    want = {r.user_id: (r.n, r.last, r.dev) for r in s.where("user_id is not null").groupBy("user_id").agg(
        F.count_distinct("session_id").alias("n"), F.max("session_start").alias("last"), F.max("device_type").alias("dev")).collect()}
    got = {r.user_id: (r.sessions or 0, r.last_start, r.device_type) for r in U.per_user(U.user_days(*facts, P)).collect() if r.session_rows}
    assert got == want


def test_leak_free_features_equal_a_cut_of_the_facts(spark):
    wh = Warehouse.from_binding(spark, SMOKE)
    got = {r.user_id: r for r in churn.features(wh, P, leak_free=True).collect()}
    subs = wh.stg_subscriptions.where(F.col("plan") != "Free").select("user_id", F.coalesce("end_date", F.lit(P.as_of)).alias("cut"))
    cut = wh.fact_sessions.join(subs, "user_id").where("session_start < cut")
    want = {r.user_id: (r.n, (r.c - r.last.date()).days if r.last else None) for r in cut.groupBy("user_id").agg(
        F.count_distinct("session_id").alias("n"), F.max("session_start").alias("last"), F.max("cut").alias("c")).collect()}
    paid = {r.user_id: r.s for r in wh.fact_payments.join(subs, "user_id").where("payment_date < cut").groupBy("user_id").agg(F.sum("amount").cast("double").alias("s")).collect()}
    assert {u for u, r in got.items() if r.session_count} == set(want)
    for u, r in got.items():
        assert r.session_count == want.get(u, (0,))[0] and r.total_revenue == pytest.approx(paid.get(u, 0.0))


@pytest.mark.parametrize("name", ["h1_rfm", "h2_segment", "k1_features", "k7_rule_score"])
def test_no_exchange_of_fact_or_mart_rows(spark, name):
    plan = E.queries()[name](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and "fact_" not in plan


def test_bucket_count_follows_the_input():
    assert bucket_count(0) == 8 and bucket_count(8 << 28) == 8 and bucket_count((8 << 28) + 1) == 16
    assert bucket_count(100 << 40) == 1 << 16
