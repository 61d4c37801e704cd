"""Rolling distinct users (E11), monthly subscription deltas (E15/E16) and
keep-first (B13) against brute force on random fixtures."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.operators import activity, experiment_log as XL, revenue

D0 = dt.date(2024, 1, 1)


def brute_rolling(pairs, days):
    out = {}
    for t in days:
        row = {}
        for name, w in activity.WINDOWS:
            row[name] = len({u for u, d in pairs if t - dt.timedelta(days=w - 1) <= d <= t})
        out[t] = row
    return out


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 70)), min_size=1, max_size=60))
def test_rolling_active_matches_brute_force(spark, events):
    rows = [(u, dt.datetime.combine(D0 + dt.timedelta(days=d), dt.time(12))) for u, d in events]
    df = spark.createDataFrame(rows, "user_id int, ts timestamp")
    got = {r["day"]: r.asDict() for r in activity.rolling_active(df, "ts").collect()}
    pairs = {(u, D0 + dt.timedelta(days=d)) for u, d in events}
    days = sorted(got)
    assert days[0] == min(d for _, d in pairs) and days[-1] == max(d for _, d in pairs)
    want = brute_rolling(pairs, days)
    for t in days:
        for name, _ in activity.WINDOWS:
            assert got[t][name] == want[t][name], (t, name)


def test_monthly_subscriptions_match_range_join(spark):
    rng = random.Random(7)
    p = Params(as_of=dt.date(2026, 6, 22))
    rows = []
    for i in range(300):
        start = dt.date(2025, 1, 1) + dt.timedelta(days=rng.randint(0, 500))
        plan = rng.choice(["Free", "Pro", "Enterprise"])
        if rng.random() < 0.4:
            end = start + dt.timedelta(days=rng.randint(0, 200))
            status = "cancelled"
        else:
            end, status = None, "active"
        rows.append((f"S{i}", f"U{i}", plan, start, end, status))
    subs = spark.createDataFrame(rows, "subscription_id string, user_id string, plan string, start_date date, end_date date, status string")
    got = {r["month"]: r for r in revenue.monthly_subscriptions(subs, p).collect()}
    prices = {"Pro": 29.0, "Enterprise": 299.0}
    paid = [r for r in rows if r[2] in prices]
    for m0, r in got.items():
        active = [s for s in paid if s[3] < m0 and (s[4] is None or s[4] >= m0)]
        assert r["active_start"] == len(active), m0
        assert r["mrr"] == pytest.approx(sum(prices[s[2]] for s in active)), m0
        canc = [s for s in paid if s[5] == "cancelled" and s[4] and (s[4].year, s[4].month) == (m0.year, m0.month)]
        assert r["cancellations"] == len(canc), m0


def test_keep_first_matches_window(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 20), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 50)), i, rng.choice("ab"))
            for i in range(400)]
    df = spark.createDataFrame(rows, "user_id int, timestamp timestamp, exposure_id int, g string")
    got = {r["user_id"]: (r["timestamp"], r["exposure_id"], r["g"]) for r in XL.keep_first(df, "user_id", ("timestamp",), "exposure_id").collect()}
    want = {}
    for u, t, e, g in sorted(rows, key=lambda r: (r[1], r[2])):
        want.setdefault(u, (t, e, g))
    assert got == want


def test_funnel_steps_independent(spark):
    from growlytics.operators import funnel

    p = Params.binding()
    ev = spark.createDataFrame([(1, "view", dt.datetime(2024, 1, 1)), (1, "purchase", dt.datetime(2024, 1, 1)),
                                (2, "view", dt.datetime(2024, 1, 1)), (2, "click", dt.datetime(2024, 1, 2))],
                               "user_id int, event_type string, event_time timestamp")
    got = {(str(r["day"]), r["step"]): r["users"] for r in funnel.funnel_by_day(ev, p).collect()}
    assert got[("2024-01-01", "1. View")] == 2 and got[("2024-01-01", "4. Purchase")] == 1
    assert got[("2024-01-01", "2. Click")] == 0 and got[("2024-01-02", "2. Click")] == 1
    overall = {r["step"]: r["users"] for r in funnel.event_funnel(ev, p).collect()}
    assert overall == {"1. View": 2, "2. Click": 1, "3. Signup": 0, "4. Purchase": 1}
    assert F is not None


def test_rolling_active_approx_close_to_exact(spark):
    rng = random.Random(11)
    rows = [(rng.randint(0, 400), dt.datetime(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 59), hours=3))
            for _ in range(5000)]
    df = spark.createDataFrame(rows, "user_id int, ts timestamp")
    exact = {r["day"]: r for r in activity.rolling_active(df, "ts").collect()}
    approx = {r["day"]: r for r in activity.rolling_active_approx(df, "ts").collect()}
    assert set(exact) == set(approx)
    for d, r in exact.items():
        for name, _ in activity.WINDOWS:
            assert abs(approx[d][name] - r[name]) <= max(2, 0.06 * r[name]), (d, name)


def test_seeded_samples(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "user_id")
    a = [r["user_id"] for r in XL.seeded_sample(df, 100, "user_id", 42).collect()]
    b = [r["user_id"] for r in XL.seeded_sample(df, 100, "user_id", 42).collect()]
    c = [r["user_id"] for r in XL.seeded_sample(df, 100, "user_id", 7).collect()]
    assert len(a) == 100 and sorted(a) == sorted(b) and sorted(a) != sorted(c)
    assert XL.seeded_sample(df, 10_000, "user_id", 42).count() == 5000  # n above rows: all rows
    frac = XL.seeded_sample_fraction(df, 0.2, "user_id", 42).count()
    assert 800 < frac < 1200


def test_rescale_maps_range_onto_window(spark):
    rows = [(1, dt.datetime(2017, 1, 2)), (2, dt.datetime(2017, 1, 12)), (3, dt.datetime(2017, 1, 22))]
    df = spark.createDataFrame(rows, "user_id int, timestamp timestamp")
    out = {r["user_id"]: r["scaled_time"] for r in XL.rescale_timestamps(
        df, "timestamp", dt.datetime(2025, 6, 22), dt.datetime(2026, 6, 22)).collect()}
    assert out[1] == dt.datetime(2025, 6, 22) and out[3] == dt.datetime(2026, 6, 22)
    assert out[2] == dt.datetime(2025, 12, 21, 12)  # midpoint
    one = spark.createDataFrame([(1, dt.datetime(2017, 1, 2))], "user_id int, timestamp timestamp")
    assert XL.rescale_timestamps(one, "timestamp", dt.datetime(2025, 6, 22), dt.datetime(2026, 6, 22)).first()[
        "scaled_time"] == dt.datetime(2025, 6, 22)  # zero range -> window start


def test_cluster_conf_applies(spark):
    from growlytics.session import CLUSTER_CONF, apply_cluster_conf

    before = spark.conf.get("spark.sql.shuffle.partitions")
    apply_cluster_conf(spark, {"spark.sql.shuffle.partitions": before})
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == CLUSTER_CONF["spark.sql.adaptive.skewJoin.enabled"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "134217728")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", before)
