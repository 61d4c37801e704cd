"""Registered queries: survival and predicted LTV."""

from pyspark.sql import functions as F

from growlytics.operators import survival as S
from growlytics.plans.oracle import r6
from growlytics.plans.registry import register

KM = """,
ten AS (
  SELECT plan, CASE WHEN status = 'cancelled' THEN 1 ELSE 0 END AS churned,
         CASE WHEN status = 'cancelled' THEN end_date - start_date ELSE DATE '2001-08-02' - start_date END AS tenure_days
  FROM subscriptions WHERE plan IN ('Pro', 'Enterprise')
),
lt AS (
  SELECT plan, tenure_days, sum(churned) AS deaths, count(*) AS total
  FROM ten WHERE tenure_days IS NOT NULL GROUP BY ALL
),
lt2 AS (
  SELECT *, sum(total) OVER (PARTITION BY plan ORDER BY tenure_days DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS at_risk
  FROM lt
),
lt3 AS (SELECT *, CASE WHEN at_risk > 0 THEN deaths / at_risk ELSE 0 END AS hazard FROM lt2),
lt4 AS (
  SELECT *, product(1 - hazard) OVER (PARTITION BY plan ORDER BY tenure_days ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS survival
  FROM lt3
),
st AS (
  SELECT plan, count(*) AS n, sum(churned) AS churns, CAST(sum(tenure_days) AS DOUBLE) AS exposure FROM ten GROUP BY plan
),
mx AS (SELECT plan, greatest(least(max(tenure_days), 730), 0) AS max_day FROM lt GROUP BY plan),
days AS (SELECT plan, max_day, unnest(range(0, max_day + 1)) AS day FROM mx),
dc AS (
  SELECT d.plan, d.day, d.max_day, CASE WHEN d.day = 0 THEN 1.0 ELSE l.survival END AS s0
  FROM days d LEFT JOIN lt4 l ON l.plan = d.plan AND l.tenure_days = d.day
),
curve AS (
  SELECT plan, day, max_day,
         coalesce(last_value(s0 IGNORE NULLS) OVER (PARTITION BY plan ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 1.0) AS survival
  FROM dc
),
life AS (
  SELECT c.plan, sum(c.survival) AS observed_days, arg_max(c.survival, c.day) AS last_survival,
         any_value(st.n) AS n, any_value(st.churns) AS churns, any_value(st.exposure) AS exposure
  FROM curve c JOIN st ON st.plan = c.plan GROUP BY c.plan
),
life2 AS (
  SELECT *, CASE WHEN exposure > 0 AND churns > 0 THEN observed_days + last_survival / (churns / exposure)
                 ELSE least(1095.0, observed_days + last_survival * 1095.0) END AS days,
         CASE plan WHEN 'Pro' THEN 29.0 WHEN 'Enterprise' THEN 299.0 END AS price
  FROM life
)
"""


@register("j1_tenure", sql="""
SELECT plan, status, strftime(start_date, '%Y-%m-%d') AS start_date, strftime(end_date, '%Y-%m-%d') AS end_date,
       CAST(CASE WHEN status = 'cancelled' THEN 1 ELSE 0 END AS BIGINT) AS churned,
       CAST(CASE WHEN status = 'cancelled' THEN end_date - start_date ELSE DATE '2001-08-02' - start_date END AS BIGINT) AS tenure_days
FROM subscriptions WHERE plan IN ('Pro', 'Enterprise')
""")
def j1_tenure(ctx):
    return S.tenure(ctx.wh.stg_subscriptions, ctx.p)


@register("j2_life_table", extra=KM, sql=f"""
SELECT plan, CAST(tenure_days AS BIGINT) AS tenure_days, CAST(deaths AS BIGINT) AS deaths, total,
       CAST(at_risk AS BIGINT) AS at_risk, {r6('hazard')} AS hazard, {r6('survival')} AS survival
FROM lt4
""")
def j2_life_table(ctx):
    return S.life_table(S.tenure(ctx.wh.stg_subscriptions, ctx.p))


def _curve(ctx):
    return S.curve_parts(ctx.wh.stg_subscriptions, ctx.p)


@register("j3_curve", extra=KM, sql=f"""
SELECT plan, CAST(day AS BIGINT) AS day, CAST(max_day AS BIGINT) AS max_day, {r6('survival')} AS survival FROM curve
""")
def j3_curve(ctx):
    return _curve(ctx)[2]


@register("j4_lifetime", extra=KM, sql=f"""
SELECT plan, {r6('price')} AS price, {r6('days')} AS expected_lifetime_days,
       {r6('days / 30.4375')} AS expected_lifetime_months, {r6('price * days / 30.4375')} AS ltv,
       CAST(n - churns AS BIGINT) AS active_users, CAST(churns AS BIGINT) AS churned_users, 'observed' AS source
FROM life2
""")
def j4_lifetime(ctx):
    summary, _ = S.survival_ltv(ctx.wh.stg_subscriptions, ctx.p)
    return summary


@register("j6_sampled", extra=KM, sql=f"""
SELECT plan, CAST(day AS BIGINT) AS day, {r6('survival')} AS survival_rate FROM curve
WHERE day % (CASE WHEN max_day < 180 THEN 10 ELSE 30 END) = 0 OR day = max_day
""")
def j6_sampled(ctx):
    _, curve = S.survival_ltv(ctx.wh.stg_subscriptions, ctx.p)
    return curve


@register("j1_negative", sql="""
, t AS (SELECT plan, CASE WHEN subscription_id % 5 = 0 THEN DATE '2001-09-01' ELSE start_date END AS start_date,
               CASE WHEN subscription_id % 11 <> 0 THEN end_date END AS end_date, status FROM subscriptions WHERE plan <> 'Free'),
d AS (SELECT plan, CASE WHEN status = 'cancelled' THEN end_date - start_date ELSE DATE '2001-08-02' - start_date END AS days FROM t)
SELECT plan, count(*) FILTER (WHERE days < 0) AS negative, count(*) FILTER (WHERE days IS NULL) AS missing FROM d GROUP BY plan
""")
def j1_negative(ctx):
    """Tenures below zero and without an end, where some starts lie after the
    as-of date and some cancelled subscriptions have no end."""
    sid = F.col("subscription_id")
    subs = ctx.wh.stg_subscriptions.withColumns({
        "start_date": F.when(sid % 5 == 0, F.lit("2001-09-01").cast("date")).otherwise(F.col("start_date")),
        "end_date": F.when(sid % 11 != 0, F.col("end_date"))})
    return S.negative_tenures(S.tenure(subs, ctx.p))


@register("j7_default", sql=f"""
, seen AS (SELECT DISTINCT plan FROM subscriptions WHERE plan = 'Pro'),
missing AS (SELECT * FROM (VALUES ('Pro', 29.0), ('Enterprise', 299.0)) p(plan, price) WHERE plan NOT IN (SELECT plan FROM seen))
SELECT plan, CAST(day AS BIGINT) AS day, {r6('pow(0.97, day / 30.0)')} AS survival_rate, {r6('price / 0.03')} AS ltv
FROM missing, (SELECT unnest(generate_series(0, 360, 30)) AS day)
""")
def j7_default(ctx):
    """Curve and LTV of the plan that has no subscriptions left."""
    subs = ctx.wh.stg_subscriptions.where("plan = 'Pro'")
    present = S.plan_stats_from_groups(S.tenure_groups(S.tenure(subs, ctx.p)), ctx.p).select("plan")
    ltv = S.default_summary(ctx.spark, present, ctx.p).select("plan", "ltv")
    return S.default_curve(ctx.spark, present, ctx.p).join(ltv, "plan")
