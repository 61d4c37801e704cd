"""Registered queries: staging (C2, C4) and marts."""

from growlytics.operators import marts
from growlytics.plans.oracle import r6
from growlytics.plans.registry import register


@register("c2_sessions", sql=f"""
SELECT session_id, user_id, strftime(session_start, '%Y-%m-%d %H:%M:%S') AS session_start,
       strftime(session_end, '%Y-%m-%d %H:%M:%S') AS session_end, device_type,
       {r6('(epoch_us(session_end) - epoch_us(session_start)) / 60000000.0')} AS session_duration_minutes
FROM sessions
""")
def c2_sessions(ctx):
    return ctx.wh_lazy.stg_sessions


@register("c4_subscriptions", sql="""
SELECT subscription_id, user_id, plan, strftime(start_date, '%Y-%m-%d') AS start_date,
       strftime(end_date, '%Y-%m-%d') AS end_date, status
FROM subscriptions
""")
def c4_subscriptions(ctx):
    return ctx.wh.stg_subscriptions


@register("d1_users", sql="""
SELECT user_id, strftime(signup_date, '%Y-%m-%d') AS signup_date, country, channel, current_plan FROM dim_users
""")
def d1_users(ctx):
    return ctx.wh.dim_users


@register("d2_dates", sql="""
, b AS (SELECT CAST(date_trunc('month', min(session_start)) AS DATE) AS d0, last_day(max(session_start)) AS d1 FROM fact_sessions),
days AS (SELECT CAST(unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE) AS d FROM b)
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_id, strftime(d, '%Y-%m-%d') AS date,
       CAST(weekofyear(d) AS BIGINT) AS week, CAST(month(d) AS BIGINT) AS month,
       CAST(quarter(d) AS BIGINT) AS quarter, CAST(year(d) AS BIGINT) AS year
FROM days
""")
def d2_dates(ctx):
    return marts.dim_dates_from_activity(ctx.wh.fact_sessions)


@register("d3_plans", sql="""
SELECT DISTINCT plan AS plan_name,
       CAST(CASE WHEN plan = 'Free' THEN 1 WHEN plan = 'Pro' THEN 2 WHEN plan = 'Enterprise' THEN 3 ELSE 0 END AS BIGINT) AS plan_id
FROM subscriptions
""")
def d3_plans(ctx):
    return marts.dim_plans(ctx.wh.stg_subscriptions)


@register("d4_variants", sql="""
SELECT user_id, experiment_id, variant, strftime(assigned_date, '%Y-%m-%d %H:%M:%S') AS assigned_date FROM experiments
""")
def d4_variants(ctx):
    return ctx.wh.dim_variants


@register("d5_fact_events", sql="""
SELECT event_id, user_id, event_type, CAST(date_id AS BIGINT) AS date_id,
       strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time
FROM fact_events
""")
def d5_fact_events(ctx):
    return ctx.wh.fact_events


@register("d6_fact_payments", sql=f"""
SELECT payment_id, user_id, {r6('amount')} AS amount, CAST(date_id AS BIGINT) AS date_id,
       strftime(payment_date, '%Y-%m-%d') AS payment_date
FROM fact_payments
""")
def d6_fact_payments(ctx):
    return ctx.wh.fact_payments


@register("d7_fact_sessions", sql=f"""
SELECT session_id, user_id, {r6('session_duration_minutes')} AS session_duration_minutes,
       CAST(date_id AS BIGINT) AS date_id, strftime(session_start, '%Y-%m-%d %H:%M:%S') AS session_start, device_type
FROM fact_sessions
""")
def d7_fact_sessions(ctx):
    return ctx.wh.fact_sessions

