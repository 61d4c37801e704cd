"""DuckDB oracle SQL for the registered queries.

Each string starts with the binding (the same dataset rules as
``growlytics.sources.binding`` written independently in SQL) and then
computes one operator with plain SQL.  Output follows the edge rules of
``growlytics.plans.edge``: dates as text, doubles rounded to 6 places,
counts as bigint, every column aliased to the Spark name.
"""

from __future__ import annotations

BINDING = """
WITH
cust_orders AS (
  SELECT o_custkey AS user_id, min(o_orderdate) AS first_ts
  FROM orders GROUP BY o_custkey
),
last_order AS (
  SELECT user_id, last_status, last_ts FROM (
    SELECT o_custkey AS user_id, o_orderstatus AS last_status, o_orderdate AS last_ts,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) t
  WHERE rn = 1
),
users AS (
  SELECT c.c_custkey AS user_id,
         CAST(co.first_ts AS DATE) AS signup_date,
         n.n_name AS country,
         CASE WHEN n.n_regionkey IN (0, 1) THEN 'Google' WHEN n.n_regionkey = 2 THEN 'Meta'
              WHEN n.n_regionkey = 3 THEN 'Organic' ELSE 'Referral' END AS acquisition_channel,
         CASE WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'Enterprise'
              WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Pro' ELSE 'Free' END AS plan_type
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN cust_orders co ON co.user_id = c.c_custkey
),
dim_users AS (
  SELECT user_id, signup_date, country, acquisition_channel AS channel, plan_type AS current_plan FROM users
),
sessions AS (
  SELECT o_orderkey AS session_id, o_custkey AS user_id, o_orderdate AS session_start,
         o_orderdate + to_minutes(CAST(2 + o_orderkey % 74 AS BIGINT)) AS session_end,
         CASE WHEN o_orderkey % 5 <= 1 THEN 'Desktop' WHEN o_orderkey % 5 <= 3 THEN 'Mobile'
              ELSE 'Tablet' END AS device_type
  FROM orders
),
fact_sessions AS (
  SELECT session_id, user_id,
         (epoch_us(session_end) - epoch_us(session_start)) / 60000000.0 AS session_duration_minutes,
         CAST(strftime(session_start, '%Y%m%d') AS INTEGER) AS date_id,
         session_start, device_type
  FROM sessions
),
payments AS (
  SELECT o_orderkey AS payment_id, o_custkey AS user_id,
         CAST(floor(o_totalprice * 100 + 0.5) / 100 AS DECIMAL(18,2)) AS amount,
         CAST(o_orderdate AS DATE) AS payment_date
  FROM orders
  WHERE o_custkey IN (SELECT user_id FROM users WHERE plan_type IN ('Pro', 'Enterprise'))
),
fact_payments AS (
  SELECT payment_id, user_id, amount, CAST(strftime(payment_date, '%Y%m%d') AS INTEGER) AS date_id, payment_date
  FROM payments
),
subscriptions AS (
  SELECT u.user_id AS subscription_id, u.user_id, u.plan_type AS plan, u.signup_date AS start_date,
         CASE WHEN l.last_status = 'F' THEN CAST(l.last_ts AS DATE) END AS end_date,
         CASE WHEN l.last_status = 'F' THEN 'cancelled' ELSE 'active' END AS status
  FROM users u JOIN last_order l ON u.user_id = l.user_id
),
experiments AS (
  SELECT 'EXP_3ARM' AS experiment_id,
         CASE WHEN u.user_id % 3 = 0 THEN 'Control' WHEN u.user_id % 3 = 1 THEN 'Variant A'
              ELSE 'Variant B' END AS variant,
         u.user_id, CAST(u.signup_date AS TIMESTAMP) AS assigned_date
  FROM users u
  UNION ALL
  SELECT 'EXP_2ARM' AS experiment_id,
         CASE WHEN u.user_id % 2 = 0 THEN 'Control' ELSE 'Variant' END AS variant,
         u.user_id, CAST(u.signup_date AS TIMESTAMP) AS assigned_date
  FROM users u JOIN customer c ON c.c_custkey = u.user_id
  WHERE c.c_acctbal > 0
),
fact_events AS (
  SELECT event_id, user_id, event_type, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_id, ts AS event_time
  FROM events
),
exp_log AS (
  SELECT o_custkey AS user_id,
         o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS "timestamp",
         CASE WHEN o_orderkey % 2 = 0 THEN 'control' ELSE 'treatment' END AS "group",
         CASE WHEN (o_orderkey % 2 = 0) = (o_orderkey % 11 <> 0) THEN 'old_page' ELSE 'new_page' END AS landing_page,
         CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS converted,
         o_orderkey AS exposure_id
  FROM orders
)
"""

# Whole days as-of minus a timestamp, truncated toward zero.
ASOF = "TIMESTAMP '2001-08-02 00:00:00'"


def days_since(expr: str, asof: str = ASOF) -> str:
    return f"CAST(trunc((epoch_us({asof}) - epoch_us({expr})) / 86400000000.0) AS BIGINT)"


def r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6)"


# Two-sided normal tail p = 2 * (1 - Phi(|z|)) by Simpson's rule over
# [0, |z|] with 2000 panels: independent of the Spark implementation.
def normal_two_sided_p(z: str) -> str:
    return (
        f"(SELECT 1 - 2 * (abs({z}) / 2000 / 3) / sqrt(2 * pi()) * sum("
        f"CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
        f" * exp(-0.5 * power(i * abs({z}) / 2000, 2))) FROM range(0, 2001) r(i))"
    )


RFM = """,
rfm AS (
  SELECT user_id, current_plan,
         coalesce((SELECT {recency} FROM fact_sessions s WHERE s.user_id = u.user_id), 365) AS recency,
         (SELECT count(DISTINCT s.session_id) FROM fact_sessions s WHERE s.user_id = u.user_id) AS frequency,
         coalesce((SELECT sum(p.amount) FROM fact_payments p WHERE p.user_id = u.user_id), 0) AS monetary
  FROM dim_users u
),
seg AS (
  SELECT *, CASE
      WHEN current_plan = 'Enterprise' AND recency < 30 THEN 'High-Value Champions'
      WHEN recency < 14 AND frequency > 12 THEN 'Power Users'
      WHEN recency < 45 AND current_plan IN ('Pro', 'Enterprise') THEN 'Loyal Customers'
      WHEN recency > 90 AND current_plan IN ('Pro', 'Enterprise') THEN 'At-Risk (Paid Churned)'
      WHEN recency > 60 THEN 'Hibernating / Dormant'
      WHEN current_plan = 'Free' AND frequency > 8 THEN 'Engaged Free Users'
      ELSE 'New / Average Users' END AS segment
  FROM rfm
)
""".replace("{recency}", days_since("max(session_start)"))
