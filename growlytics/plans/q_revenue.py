"""Registered queries: documented monthly churn, MRR and LTV."""

from pyspark.sql import functions as F

from growlytics.operators import revenue
from growlytics.plans.oracle import r6
from growlytics.plans.registry import register

# Brute force range join of paid subscriptions against month starts.
MONTHLY = """,
ps AS (
  SELECT *, CASE plan WHEN 'Pro' THEN 29.0 WHEN 'Enterprise' THEN 299.0 END AS price
  FROM subscriptions WHERE plan IN ('Pro', 'Enterprise')
),
months AS (
  SELECT CAST(unnest(generate_series(CAST(date_trunc('month', min(start_date)) AS DATE), DATE '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS m
  FROM ps
),
act AS (
  SELECT months.m, count(ps.user_id) AS active_start, coalesce(sum(ps.price), 0) AS mrr
  FROM months LEFT JOIN ps ON ps.start_date < months.m AND (ps.end_date IS NULL OR ps.end_date >= months.m)
  GROUP BY months.m
),
canc AS (
  SELECT CAST(date_trunc('month', end_date) AS DATE) AS m, count(*) AS cancellations
  FROM ps WHERE status = 'cancelled' AND end_date IS NOT NULL GROUP BY 1
),
mon AS (
  SELECT act.m, act.active_start, act.mrr, coalesce(canc.cancellations, 0) AS cancellations,
         CASE WHEN act.active_start > 0 THEN coalesce(canc.cancellations, 0) * 100.0 / act.active_start END AS churn_rate
  FROM act LEFT JOIN canc ON act.m = canc.m
)
"""


@register("e15_churn_month", extra=MONTHLY, sql=f"""
SELECT strftime(m, '%Y-%m-%d') AS month, active_start, {r6('mrr')} AS mrr, cancellations, {r6('churn_rate')} AS churn_rate
FROM mon
""")
def e15_churn_month(ctx):
    return revenue.monthly_subscriptions(ctx.wh.stg_subscriptions, ctx.p)


@register("e16_mrr_month", extra=MONTHLY, sql=f"""
SELECT strftime(m, '%Y-%m-%d') AS month, {r6('mrr')} AS mrr, {r6('mrr * 12')} AS arr FROM mon
""")
def e16_mrr_month(ctx):
    m = revenue.monthly_subscriptions(ctx.wh.stg_subscriptions, ctx.p)
    return m.select("month", "mrr", (F.col("mrr") * 12).alias("arr"))


@register("e17_ltv", extra=MONTHLY, sql=f"""
, mau AS (SELECT CAST(date_trunc('month', session_start) AS DATE) AS m, count(DISTINCT user_id) AS mau
          FROM fact_sessions WHERE user_id IS NOT NULL GROUP BY 1),
j AS (SELECT mon.*, coalesce(mau.mau, 0) AS mau FROM mon LEFT JOIN mau ON mon.m = mau.m)
SELECT strftime(m, '%Y-%m-%d') AS month, {r6('mrr')} AS mrr, mau,
       {r6('CASE WHEN mau > 0 THEN mrr / mau END')} AS arpu, {r6('churn_rate')} AS churn_rate,
       {r6('CASE WHEN mau > 0 AND churn_rate <> 0 THEN (mrr / mau) / (churn_rate / 100.0) END')} AS ltv
FROM j
""")
def e17_ltv(ctx):
    return revenue.monthly_ltv(ctx.wh.stg_subscriptions, ctx.wh.fact_sessions, ctx.p)
