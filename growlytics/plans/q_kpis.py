"""Registered queries: KPI aggregates (E1-E10), funnel."""

from pyspark.sql import functions as F

from growlytics.operators import funnel, kpis
from growlytics.plans.oracle import r6
from growlytics.plans.registry import register

LATEST = """
, latest AS (SELECT user_id, max(session_start) AS last_seen FROM fact_sessions WHERE user_id IS NOT NULL GROUP BY user_id)
"""
E2_SQL = """
SELECT (SELECT count(*) FROM latest) AS mau,
       (SELECT count(*) FROM latest WHERE last_seen >= TIMESTAMP '2001-07-26') AS wau,
       (SELECT count(*) FROM latest WHERE last_seen >= TIMESTAMP '2001-08-01') AS dau
"""


@register("e1_total_users", sql="SELECT count(*) AS total_users FROM dim_users")
def e1_total_users(ctx):
    return kpis.total_users(ctx.wh.dim_users)


@register("e2_active", sql=LATEST + E2_SQL)
def e2_active(ctx):
    return kpis.active_users(ctx.wh.user_days, ctx.p)


@register("e3_mrr", sql=f"""
SELECT {r6('coalesce(sum(amount), 0)')} AS mrr, {r6('coalesce(sum(amount), 0) * 12')} AS arr
FROM fact_payments WHERE payment_date >= DATE '2001-07-02'
""")
def e3_mrr(ctx):
    return kpis.mrr(ctx.wh.fact_payments, ctx.p)


@register("e5_churn", sql=f"""
SELECT count(CASE WHEN status = 'cancelled' THEN 1 END) AS churned, count(*) AS total_paid,
       {r6("CASE WHEN count(*) > 0 THEN count(CASE WHEN status = 'cancelled' THEN 1 END) / count(*) * 100 ELSE 0 END")} AS churn_rate
FROM subscriptions WHERE plan IN ('Pro', 'Enterprise')
""")
def e5_churn(ctx):
    return kpis.paid_churn(ctx.wh.stg_subscriptions, ctx.p)


@register("e7_rev_plan", sql=f"""
SELECT s.plan AS label, {r6('sum(p.amount)')} AS value
FROM fact_payments p JOIN subscriptions s ON p.user_id = s.user_id GROUP BY s.plan
""")
def e7_rev_plan(ctx):
    return kpis.revenue_by_plan(ctx.wh.user_days, ctx.wh.stg_subscriptions)


@register("e8_rev_channel", sql=f"""
SELECT u.channel AS label, {r6('sum(p.amount)')} AS value
FROM fact_payments p JOIN dim_users u ON p.user_id = u.user_id GROUP BY u.channel
""")
def e8_rev_channel(ctx):
    return kpis.revenue_by_channel(ctx.wh.user_days, ctx.wh.dim_users)


@register("e9_kpis", sql=f"""{LATEST}
, a AS ({E2_SQL}),
m AS (SELECT CAST(coalesce(sum(amount), 0) AS DOUBLE) AS mrr FROM fact_payments WHERE payment_date >= DATE '2001-07-02'),
c AS (SELECT CASE WHEN count(*) > 0 THEN count(CASE WHEN status = 'cancelled' THEN 1 END) / count(*) * 100 ELSE 0 END AS churn_rate
      FROM subscriptions WHERE plan IN ('Pro', 'Enterprise')),
k AS (
  SELECT (SELECT count(*) FROM dim_users) AS total_users, a.dau, a.wau, a.mau, m.mrr, m.mrr * 12 AS arr,
         CASE WHEN a.mau > 0 THEN m.mrr / a.mau ELSE 0 END AS arpu, c.churn_rate
  FROM a, m, c
)
SELECT total_users, dau, wau, mau, {r6('mrr')} AS mrr, {r6('arr')} AS arr, {r6('arpu')} AS arpu,
       {r6('churn_rate')} AS churn_rate,
       {r6('CASE WHEN churn_rate / 100.0 / 12.0 > 0 THEN arpu / (churn_rate / 100.0 / 12.0) ELSE arpu * 24 END')} AS ltv
FROM k
""")
def e9_kpis(ctx):
    return kpis.kpi_summary(ctx.wh, ctx.p)


@register("e9_breakdown", sql=f"""
, by_plan AS (SELECT s.plan AS label, sum(p.amount) AS value FROM fact_payments p JOIN subscriptions s ON p.user_id = s.user_id GROUP BY s.plan),
by_channel AS (SELECT u.channel AS label, sum(p.amount) AS value FROM fact_payments p JOIN dim_users u ON p.user_id = u.user_id GROUP BY u.channel),
n AS (SELECT count(*) AS total_users FROM dim_users)
SELECT total_users, 'plan' AS breakdown, label, {r6('value')} AS value FROM n, by_plan
UNION ALL SELECT total_users, 'channel', label, {r6('value')} FROM n, by_channel
""")
def e9_breakdown(ctx):
    """The plan and channel lists that the KPI record carries, one row per
    entry (beside the record's number of users)."""
    row = kpis.kpi_summary(ctx.wh, ctx.p, with_breakdowns=True)
    lists = F.array(*[
        F.struct(F.lit(name).alias("breakdown"), F.col(f"{name}_revenue").alias("entries")) for name in ("plan", "channel")
    ])
    one = row.select("total_users", F.inline(lists))
    return one.select("total_users", "breakdown", F.inline("entries"))


@register("e10_monthly", sql="""
SELECT strftime(session_start, '%Y-%m') AS month, count(DISTINCT user_id) AS active_users
FROM fact_sessions GROUP BY 1 ORDER BY 1
""")
def e10_monthly(ctx):
    return kpis.monthly_active_users(ctx.wh.user_days)


F1_SQL = """
, steps(step, event_type) AS (VALUES ('1. View', 'view'), ('2. Click', 'click'), ('3. Signup', 'signup'), ('4. Purchase', 'purchase')),
tagged AS (
  SELECT DISTINCT CAST(e.event_time AS DATE) AS day, s.step, e.user_id
  FROM fact_events e JOIN steps s ON e.event_type = s.event_type WHERE e.user_id IS NOT NULL
),
counts AS (SELECT day, step, count(DISTINCT user_id) AS users FROM tagged GROUP BY day, step),
grid AS (SELECT d.day, s.step FROM (SELECT DISTINCT day FROM counts) d, (SELECT DISTINCT step FROM steps) s)
SELECT strftime(g.day, '%Y-%m-%d') AS day, g.step, coalesce(c.users, 0) AS users
FROM grid g LEFT JOIN counts c ON g.day = c.day AND g.step = c.step
"""


@register("f1_funnel", sql=F1_SQL)
def f1_funnel(ctx):
    return funnel.funnel_by_day(ctx.wh.fact_events, ctx.p)


@register("f2_channel", sql=f"""
, paid AS (SELECT user_id, bool_or(plan IN ('Pro', 'Enterprise')) AS paid FROM subscriptions GROUP BY user_id)
SELECT u.channel, count(DISTINCT u.user_id) AS total_users,
       count(DISTINCT CASE WHEN p.paid THEN u.user_id END) AS paid_conversions,
       {r6("CASE WHEN count(DISTINCT u.user_id) > 0 THEN count(DISTINCT CASE WHEN p.paid THEN u.user_id END) / count(DISTINCT u.user_id) * 100 ELSE 0 END")} AS conversion_rate
FROM dim_users u LEFT JOIN paid p ON u.user_id = p.user_id GROUP BY u.channel
""")
def f2_channel(ctx):
    return funnel.conversion_by_channel(ctx.wh.dim_users, ctx.wh.stg_subscriptions, ctx.p)


@register("e13_signup_rate", sql=f"""
, flags AS (
  SELECT user_id, bool_or(event_type = 'view') AS landed, bool_or(event_type = 'signup') AS signed
  FROM fact_events WHERE user_id IS NOT NULL AND event_type IN ('view', 'signup') GROUP BY user_id
)
SELECT count(*) FILTER (WHERE landed) AS landing_users, count(*) FILTER (WHERE signed) AS signup_users,
       {r6("CASE WHEN count(*) FILTER (WHERE landed) > 0 THEN count(*) FILTER (WHERE signed) * 100.0 / count(*) FILTER (WHERE landed) END")} AS conversion_rate
FROM flags
""")
def e13_signup_rate(ctx):
    return funnel.landing_to_signup(ctx.wh.fact_events, ctx.p)


@register("e14_upgrade", sql=f"""
, paid AS (SELECT DISTINCT user_id FROM subscriptions WHERE plan IN ('Pro', 'Enterprise'))
SELECT count(*) AS registered_users, count(p.user_id) AS paid_users,
       {r6("CASE WHEN count(*) > 0 THEN count(p.user_id) * 100.0 / count(*) END")} AS upgrade_rate
FROM dim_users u LEFT JOIN paid p ON u.user_id = p.user_id
""")
def e14_upgrade(ctx):
    return funnel.signup_to_upgrade(ctx.wh.dim_users, ctx.wh.stg_subscriptions, ctx.p)


@register("f1_funnel_total", sql="""
, steps(step, event_type) AS (VALUES ('1. View', 'view'), ('2. Click', 'click'), ('3. Signup', 'signup'), ('4. Purchase', 'purchase')),
counts AS (
  SELECT s.step, count(DISTINCT e.user_id) AS users
  FROM fact_events e JOIN steps s ON e.event_type = s.event_type WHERE e.user_id IS NOT NULL GROUP BY s.step
)
SELECT s.step, coalesce(c.users, 0) AS users FROM (SELECT DISTINCT step FROM steps) s LEFT JOIN counts c ON s.step = c.step
""")
def f1_funnel_total(ctx):
    """F1 over all time, as the dashboard computes it (no split)."""
    return funnel.event_funnel(ctx.wh.fact_events, ctx.p)


# A funnel on which the steps differ: signups, purchases and views only of some users.
STEPS = """,
ev AS (
  SELECT * FROM fact_events
  WHERE NOT (event_type = 'signup' AND user_id % 3 <> 0) AND NOT (event_type = 'purchase' AND user_id % 7 <> 0) AND NOT (event_type = 'view' AND user_id % 10 = 0)
)
"""


def _steps(ctx):
    u, t = F.col("user_id"), F.col("event_type")
    return ctx.wh.fact_events.where(~((t == "signup") & (u % 3 != 0)) & ~((t == "purchase") & (u % 7 != 0)) & ~((t == "view") & (u % 10 == 0)))


@register("f1_funnel_steps", extra=STEPS, sql="""
SELECT s.step, count(DISTINCT e.user_id) AS users
FROM (VALUES ('1. View', 'view'), ('2. Click', 'click'), ('3. Signup', 'signup'), ('4. Purchase', 'purchase')) s(step, kind) LEFT JOIN ev e ON e.event_type = s.kind
GROUP BY s.step
""")
def f1_funnel_steps(ctx):
    """F1 where every step has other users."""
    return funnel.event_funnel(_steps(ctx), ctx.p)


@register("e13_signup_steps", extra=STEPS, sql=f"""
SELECT count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS landing_users, count(DISTINCT user_id) FILTER (WHERE event_type = 'signup') AS signup_users,
       {r6("count(DISTINCT user_id) FILTER (WHERE event_type = 'signup') * 100.0 / nullif(count(DISTINCT user_id) FILTER (WHERE event_type = 'view'), 0)")} AS conversion_rate
FROM ev
""")
def e13_signup_steps(ctx):
    """E13 where fewer users sign up than land."""
    return funnel.landing_to_signup(_steps(ctx), ctx.p)
