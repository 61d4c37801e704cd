"""Kaplan-Meier golden case and RFM segment boundaries (FIXTURES.md)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.operators import segments, survival as S

P = Params()  # as-of 2026-06-22


def _subs(spark, rows):
    """rows of (plan, tenure, churned) -> stg_subscriptions rows."""
    out = []
    for i, (plan, t, churned) in enumerate(rows):
        if churned:
            start = dt.date(2025, 1, 1)
            end, status = start + dt.timedelta(days=t), "cancelled"
        else:
            start, end, status = P.as_of - dt.timedelta(days=t), None, "active"
        out.append((f"S{i}", f"U{i}", plan, start, end, status))
    return spark.createDataFrame(
        out, "subscription_id string, user_id string, plan string, start_date date, end_date date, status string"
    )


@pytest.fixture(scope="module")
def golden(spark):
    return _subs(spark, [("Pro", 0, 1), ("Pro", 10, 1), ("Pro", 10, 0), ("Pro", 20, 0), ("Pro", 30, 1), ("Pro", 45, 0)])


def test_life_table(spark, golden):
    lt = {r["tenure_days"]: r for r in S.life_table(S.tenure(golden, P)).collect()}
    assert [lt[t]["at_risk"] for t in (0, 10, 20, 30, 45)] == [6, 5, 3, 2, 1]
    assert [lt[t]["deaths"] for t in (0, 10, 20, 30, 45)] == [1, 1, 0, 1, 0]
    expect = [5 / 6, 2 / 3, 2 / 3, 1 / 3, 1 / 3]
    for t, s in zip((0, 10, 20, 30, 45), expect):
        assert lt[t]["survival"] == pytest.approx(s, rel=1e-12)


def test_curve_and_ltv(spark, golden):
    summary, curve = S.survival_ltv(golden, P)
    pro = summary.where("plan = 'Pro'").first()
    assert pro["expected_lifetime_days"] == pytest.approx(41.444444, abs=1e-6)
    assert pro["expected_lifetime_months"] == pytest.approx(1.361624, abs=1e-6)
    assert pro["ltv"] == pytest.approx(39.487109, abs=1e-6)
    assert (pro["active_users"], pro["churned_users"]) == (3, 3)
    days = [r["day"] for r in curve.where("plan = 'Pro'").orderBy("day").collect()]
    assert days == [0, 10, 20, 30, 40, 45]
    first = curve.where("plan = 'Pro' AND day = 0").first()["survival_rate"]
    assert first == 1.0  # forced at day 0 despite the day-0 churn
    # Enterprise has no rows: the fallback curve and LTV = price / 0.03
    ent = summary.where("plan = 'Enterprise'").first()
    assert ent["source"] == "default" and ent["ltv"] == pytest.approx(299 / 0.03)
    ent_curve = curve.where("plan = 'Enterprise'").orderBy("day").collect()
    assert [r["day"] for r in ent_curve] == list(range(0, 361, 30))
    assert ent_curve[1]["survival_rate"] == pytest.approx(0.97)


def test_daily_curve_sum(spark, golden):
    ten = S.tenure(golden, P)
    lt = S.life_table(ten)
    stats = S.plan_stats(ten, lt, P)
    c = S.daily_curve(lt, stats)
    assert c.agg(F.sum("survival")).first()[0] == pytest.approx(28.666667, abs=1e-6)
    assert stats.first()["exposure"] == 115


@pytest.mark.parametrize("plan,r,f,expected", [
    ("Enterprise", 29, 0, "High-Value Champions"), ("Enterprise", 30, 0, "Loyal Customers"),
    ("Pro", 13, 41, "Power Users"), ("Pro", 13, 40, "Loyal Customers"),
    ("Pro", 44, 0, "Loyal Customers"), ("Pro", 45, 0, "New / Average Users"),
    ("Pro", 60, 0, "New / Average Users"), ("Pro", 61, 0, "Hibernating / Dormant"),
    ("Pro", 90, 0, "Hibernating / Dormant"), ("Pro", 91, 0, "At-Risk (Paid Churned)"),
    ("Free", 20, 16, "Engaged Free Users"), ("Free", 20, 15, "New / Average Users"),
    ("Free", 61, 16, "Hibernating / Dormant"),
])
def test_segment_boundaries(spark, plan, r, f, expected):
    df = spark.createDataFrame([(plan, r, f)], "current_plan string, recency int, frequency int")
    got = df.select(segments.segment_rule(F.col("current_plan"), F.col("recency"), F.col("frequency"), P)).first()[0]
    assert got == expected


def test_segment_counts_sum_to_users(spark):
    from growlytics.sources.warehouse import Warehouse

    wh = Warehouse.from_binding(spark, "/root/testdata/sf0.001")
    p = Params.binding()
    summary = segments.rfm_segments(wh, p)
    assert summary.agg(F.sum("user_count")).first()[0] == wh.dim_users.count()


def test_reference_calendar(spark):
    from growlytics.operators import marts

    d = marts.dim_dates_for_range(spark, P.calendar_start, P.calendar_end)
    rows = {r["date_id"]: r for r in d.collect()}
    assert len(rows) == 396
    assert rows[20260101]["week"] == 1 and rows[20251229]["week"] == 1  # ISO week of 2026 starts 2025-12-29
    assert rows[20250601]["quarter"] == 2 and rows[20260701]["year"] == 2026


def test_kpi_breakdowns_sum_to_totals(spark):
    from growlytics.operators import kpis
    from growlytics.sources.warehouse import Warehouse

    wh = Warehouse.from_binding(spark, "/root/testdata/sf0.001")
    p = Params.binding()
    row = kpis.kpi_summary(wh, p, with_breakdowns=True).first()
    total = wh.fact_payments.agg(F.sum("amount").cast("double")).first()[0]
    assert sum(x["value"] for x in row["channel_revenue"]) == pytest.approx(total)
    assert sum(x["value"] for x in row["plan_revenue"]) == pytest.approx(total)  # one subscription per user
    assert row["dau"] <= row["wau"] <= row["mau"] <= row["total_users"]
