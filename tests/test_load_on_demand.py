"""The load writes what is read, once, and what it derives is derived once."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from growlytics.config import Params
from growlytics.operators import activity, churn, user_days as U
from growlytics.sources.binding import bind
from growlytics.sources.warehouse import MADE_FROM, RAW_DATASETS, Warehouse, materialized_binding

P = Params.binding()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    t = dt.datetime
    segments = ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY", None]

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{d}/{name}.parquet")

    put("nation", [(i, f"N{i}", i % 5) for i in range(6)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(i, f"c{i}", i % 7, float(i % 5 - 1) if i % 4 else None, segments[i % 5]) for i in range(60)] + [(3, "c3", 3, 1.0, "BUILDING")],
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    orders = [(i, i * 7 % 53, "FOP"[i % 3], i * 1.5, t(2001, 1 + i % 7, 1 + i % 3)) for i in range(400)]
    put("orders", orders + orders[:9] + [(500, None, "F", 2.0, t(2001, 1, 1)), (501, 4, None, None, None)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp")
    put("events", [(i, t(2001, 1 + i % 7, 1 + i % 4), i % 60, ["click", "view", None][i % 3]) for i in range(300)],
        "event_id long, ts timestamp, user_id long, event_type string")
    return d


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_a_table_is_written_when_it_is_read_and_once(spark, folder, tmp_path):
    landed = materialized_binding(spark, folder, str(tmp_path), "once", 8)
    root = next((tmp_path / "warehouse").iterdir())
    made = lambda: {p.name.removesuffix(".complete"): p.stat().st_mtime_ns for p in root.glob("*/*.complete")}
    assert made() == {}
    assert {r["dataset"] for r in landed.profile("users", "payments")} == {"users", "payments"}
    first = made()
    assert set(first) == {"customer_orders", "users", "payments"}
    landed.wh.fact_sessions.count()
    assert set(made()) == {*first, "sessions", "fact_sessions"}
    landed.whole()
    assert set(made()) == set(MADE_FROM) and all(made()[n] == at for n, at in first.items())


def test_what_is_landed_equals_the_binding(spark, folder, tmp_path):
    landed, plain = materialized_binding(spark, folder, str(tmp_path), "equal", 8), bind(spark, folder)
    for name in RAW_DATASETS:
        want = _rows(plain.raw(name))
        assert want and _rows(landed.raw(name)) == want
    # the orders are scanned for the first and last order once, not for each dataset
    for name in ("payments", "subscriptions", "experiments"):
        plan = landed._binding.raw(name)._jdf.queryExecution().optimizedPlan().toString()
        assert "max_by" not in plan


def test_experiments_are_made_in_one_pass(spark, folder):
    plan = bind(spark, folder).experiments._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o_custkey") and plan.count("max_by(") <= 2 and "Union" not in plan
    rows = bind(spark, folder).experiments.collect()
    rich = {r.c_custkey for r in spark.read.parquet(f"{folder}/customer.parquet").where("c_acctbal > 0").collect()}
    assert {r.user_id for r in rows if r.experiment_id == "EXP_2ARM"} == rich & {r.user_id for r in rows if r.experiment_id == "EXP_3ARM"}


def test_the_written_user_days_equal_the_derived(spark, folder, tmp_path):
    landed = materialized_binding(spark, folder, str(tmp_path), "days", 8)
    facts = landed.wh.fact_sessions, landed.wh.fact_events, landed.wh.fact_payments
    written = landed.wh.user_days
    assert _rows(written) == _rows(U.user_days(*facts, P)) and written.count() == written.select("user_id", "day").distinct().count()
    # sessions: first days of ids; devices: the largest name of a day
    s = facts[0].where("user_id is not null")
    firsts = s.groupBy("user_id", "session_id").agg(F.min("session_start").alias("t")).groupBy("user_id", F.to_date("t").alias("day")).count()
    want = {(r.user_id, r.day): r["count"] for r in firsts.collect()}
    assert {(r.user_id, r.day): r.sessions for r in written.where("sessions > 0").collect()} == want


def test_user_days_take_no_sort_before_their_shuffles(spark, folder):
    wh = Warehouse.from_binding(spark, folder)
    facts = [getattr(wh, n).localCheckpoint() for n in ("fact_sessions", "fact_events", "fact_payments")]
    plan = U.user_days(*facts, P, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3  # ids of sessions, states of days, buckets
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "SortAggregate" not in below


def test_rolling_dates_take_no_second_shuffle_of_days(spark, folder):
    df = activity.rolling_active(bind(spark, folder).sessions, "session_start")
    plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())
    assert len(re.findall(r"hashpartitioning\(user_id, day", plan)) == 1


def test_the_split_reads_features_that_were_written_once(spark, folder):
    split = E.queries()["k3_split"](spark, folder)
    assert "user_days" not in split._jdf.queryExecution().optimizedPlan().toString()
    landed = materialized_binding(spark, folder, str(folder) + "-kept", "features", 8)
    assert {r.user_id for r in split.collect()} == {r.user_id for r in churn.features(landed.wh, P).collect()}


def test_devices_of_features_are_merged_by_a_hash_first(spark, folder, tmp_path):
    landed = materialized_binding(spark, folder, str(tmp_path), "devices", 8)
    plan = re.sub(r"#\d+L?", "", churn.features(landed.wh, P)._jdf.queryExecution().executedPlan().toString())
    assert "HashAggregate(keys=[user_id, device_type]" in plan
    assert "Exchange hashpartitioning" not in plan
