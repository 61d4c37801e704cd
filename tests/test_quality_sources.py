"""Cleaning fixtures (FIXTURES.md section 6), data tests, CSV scan and sinks."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from growlytics.operators import quality as Q, staging
from growlytics.sources import files


@pytest.fixture(scope="module")
def payments(spark):
    rows = [("P1", "U1", 29.0, "2026-01-01"), ("P2", "U1", 0.0, "2026-01-02"), ("P3", "U2", -5.0, "2026-01-03"),
            ("P4", "U3", None, "2026-01-04"), ("P1", "U1", 29.0, "2026-01-01")]
    return spark.createDataFrame(rows, "payment_id string, user_id string, amount double, payment_date string")


def test_quality_report_payments(spark, payments):
    r = Q.quality_report(payments, "payments").first()
    assert (r["initial_row_count"], r["duplicate_rows_removed"], r["final_row_count"],
            r["validation_failures_removed"]) == (5, 1, 1, 3)
    cleaned = Q.clean(payments, "payments").collect()
    assert [x["amount"] for x in cleaned] == [29.0]


def test_full_report_has_null_maps(spark, payments):
    r = Q.full_report(payments, "payments").first()
    assert r["null_counts"]["amount"] == 1 and r["null_rates"]["amount"] == pytest.approx(0.2)


def test_null_profile_counts_before_dedupe(spark, payments):
    prof = {r["column"]: r for r in Q.null_profile(payments, "payments").collect()}
    assert prof["amount"]["null_count"] == 1 and prof["amount"]["row_count"] == 5
    empty = spark.createDataFrame([], payments.schema)
    assert {r["null_rate"] for r in Q.null_profile(empty, "x").collect()} == {None}


def test_user_defaults_and_open_end_dates(spark):
    users = spark.createDataFrame([("U1", "2026-01-01", None, "Google", None)],
                                  "user_id string, signup_date string, country string, acquisition_channel string, plan_type string")
    r = Q.clean(users, "users").first()
    assert (r["country"], r["plan_type"]) == ("Unknown", "Free")
    subs = spark.createDataFrame([("S1", "U1", "Pro", "2026-01-01", "", "active"),
                                  ("S2", "U2", "Pro", "2026-01-01", "2026-02-01", "cancelled")],
                                 "subscription_id string, user_id string, plan string, start_date string, end_date string, status string")
    ends = {r["subscription_id"]: r["end_date"] for r in staging.stg_subscriptions(subs).collect()}
    assert ends["S1"] is None and str(ends["S2"]) == "2026-02-01"


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    r = Q.duplicate_stats(df, "t").first()
    assert (r["initial_rows"], r["distinct_rows"], r["duplicate_rows"]) == (3, 2, 1)


def test_data_tests(spark):
    users = spark.createDataFrame([("U1",), ("U2",), ("U2",), (None,)], "user_id string")
    sessions = spark.createDataFrame([("S1", "U1"), ("S2", "U9"), ("S3", None)], "session_id string, user_id string")
    assert [r["user_id"] for r in Q.unique_test(users, ["user_id"]).collect()] == ["U2"]
    nn = Q.not_null_failures(users, "users", ["user_id"]).first()
    assert nn["failures"] == 1
    orphans = Q.relationship_orphans(sessions, "user_id", users, "user_id").collect()
    assert [r["session_id"] for r in orphans] == ["S2"]
    subs = spark.createDataFrame([("active",), ("paused",), ("paused",)], "status string")
    bad = Q.accepted_values_failures(subs, "status", ["active", "cancelled"]).first()
    assert (bad["value"], bad["n"]) == ("paused", 2)


def test_csv_scan_na_tokens_and_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="growlytics-csv-")
    p = os.path.join(d, "users.csv")
    with open(p, "w") as fh:
        fh.write("user_id,signup_date,country,acquisition_channel,plan_type\n")
        fh.write("USR_1,2026-01-05,US,Google,Pro\n")
        fh.write("USR_2,2026-02-01,NA,Meta,\n")
        fh.write("USR_3,2026-03-01,n/a,NULL,Free\n")
    raw = files.read_raw(spark, "users", p)
    rows = {r["user_id"]: r for r in raw.collect()}
    assert rows["USR_2"]["country"] is None and rows["USR_2"]["plan_type"] is None
    assert rows["USR_3"]["country"] is None and rows["USR_3"]["acquisition_channel"] is None
    stg = staging.stg_users(raw)
    assert stg.schema["signup_date"].dataType.simpleString() == "date"
    out = os.path.join(d, "clean_users")
    files.write_clean(Q.clean(raw, "users"), out)
    back = spark.read.parquet(out)
    assert back.where("country = 'Unknown'").count() == 2
    rep = os.path.join(d, "report")
    files.write_report(Q.quality_report(raw, "users"), rep)
    assert spark.read.json(rep).first()["initial_row_count"] == 3


def test_missing_raw_file_fails_fast(spark):
    with pytest.raises(Exception):
        files.read_raw(spark, "users", "/nonexistent/growlytics/users.csv").collect()


def test_warehouse_roundtrip(spark, tmp_path):
    from growlytics.config import Params
    from growlytics.operators import kpis
    from growlytics.sources.warehouse import Warehouse, write_warehouse

    wh = Warehouse.from_binding(spark, "/root/testdata/sf0.001")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS gw LOCATION '{tmp_path}/gw'")
    write_warehouse(wh, prefix="gw.", buckets=4)
    stored = Warehouse.from_tables(spark, prefix="gw.")
    p = Params.binding()
    a = kpis.kpi_summary(wh, p).first().asDict()
    b = kpis.kpi_summary(stored, p).first().asDict()
    assert a == b
    # month partitions prune the MRR cutoff scan
    plan = kpis.mrr(stored.fact_payments, p)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "PushedFilters" in plan
    spark.sql("DROP DATABASE gw CASCADE")


def test_csv_experiment_log(spark, tmp_path):
    p = tmp_path / "ab.csv"
    p.write_text("user_id,timestamp,group,landing_page,converted\n1,2017-01-21 22:11:48.556739,control,old_page,0\n")
    df = files.read_experiment_log(spark, str(p))
    r = df.first()
    assert r["timestamp"] is not None and r["converted"] == 0
    assert df.select(F.hour("timestamp")).first()[0] == 22


def test_billing_schedule_matches_reconcile(spark):
    import datetime as dt

    from growlytics.config import Params
    from growlytics.operators import billing

    p = Params(as_of=dt.date(2026, 6, 22))
    subs = spark.createDataFrame(
        [("S1", "U1", "Pro", dt.date(2026, 1, 1), None, "active"),
         ("S2", "U2", "Enterprise", dt.date(2026, 3, 1), dt.date(2026, 4, 15), "cancelled"),
         ("S3", "U3", "Pro", dt.date(2026, 5, 1), dt.date(2026, 5, 1), "cancelled"),
         ("S4", "U4", "Free", dt.date(2026, 1, 1), None, "active")],
        "subscription_id string, user_id string, plan string, start_date date, end_date date, status string")
    pays = spark.createDataFrame([("P1", "U1", 29.0), ("P9", "U9", 5.0)], "payment_id string, user_id string, amount double")
    sched = {}
    for r in billing.schedule(subs, p).collect():
        sched.setdefault(r["user_id"], []).append(r["charge_date"])
    # Jan 1 + 30k before Jun 22 -> 6 charges; U2: Mar 1, Mar 31 (< Apr 15); U3: first charge only
    assert len(sched["U1"]) == 6 and sorted(sched["U2"]) == [dt.date(2026, 3, 1), dt.date(2026, 3, 31)]
    assert sched["U3"] == [dt.date(2026, 5, 1)] and "U4" not in sched
    rec = {r["user_id"]: r for r in billing.reconcile(subs, pays, p).collect()}
    for u, dates in sched.items():
        assert rec[u]["expected_charges"] == len(dates)
    assert rec["U2"]["expected_amount"] == 2 * 299.0
    assert rec["U9"]["expected_charges"] == 0 and rec["U9"]["paid_count"] == 1
