"""Registered queries: rolling active users."""

from growlytics.operators import activity
from growlytics.plans.oracle import r6
from growlytics.plans.registry import register

# Brute force: every calendar day joined to the active days of its 30-day
# window, distinct users counted per window length.
ROLLING = """,
ud AS (SELECT DISTINCT user_id, CAST(event_time AS DATE) AS d FROM fact_events WHERE user_id IS NOT NULL),
cal AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS t FROM ud),
roll AS (
  SELECT cal.t,
         count(DISTINCT CASE WHEN ud.d = cal.t THEN ud.user_id END) AS dau,
         count(DISTINCT CASE WHEN ud.d > cal.t - 7 THEN ud.user_id END) AS wau,
         count(DISTINCT ud.user_id) AS mau
  FROM cal LEFT JOIN ud ON ud.d <= cal.t AND ud.d > cal.t - 30
  GROUP BY cal.t
)
"""


@register("e11_rolling", extra=ROLLING, sql="""
SELECT strftime(t, '%Y-%m-%d') AS day, dau, wau, mau FROM roll
""")
def e11_rolling(ctx):
    return activity.rolling_active(ctx.wh.fact_events, "event_time")


@register("e12_ratio", extra=ROLLING, sql=f"""
SELECT strftime(t, '%Y-%m-%d') AS day, dau, mau, {r6('CASE WHEN mau > 0 THEN dau * 100.0 / mau END')} AS engagement_ratio
FROM roll
""")
def e12_ratio(ctx):
    return activity.engagement_ratio(activity.rolling_active(ctx.wh.fact_events, "event_time"))


@register("e11_rolling_sessions", sql="""
, ud AS (SELECT DISTINCT user_id, CAST(session_start AS DATE) AS d FROM fact_sessions WHERE user_id IS NOT NULL),
cal AS (SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS t FROM ud),
roll AS (
  SELECT cal.t,
         count(DISTINCT CASE WHEN ud.d = cal.t THEN ud.user_id END) AS dau,
         count(DISTINCT CASE WHEN ud.d > cal.t - 7 THEN ud.user_id END) AS wau,
         count(DISTINCT ud.user_id) AS mau
  FROM cal LEFT JOIN ud ON ud.d <= cal.t AND ud.d > cal.t - 30
  GROUP BY cal.t
)
SELECT strftime(t, '%Y-%m-%d') AS day, dau, wau, mau FROM roll
""")
def e11_rolling_sessions(ctx):
    """E11 over sessions (orders): 2,400 calendar days of activity."""
    return activity.rolling_active(ctx.wh.fact_sessions, "session_start")

