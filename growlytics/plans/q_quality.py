"""Registered queries: profiling, cleaning, data tests (B1-B11), experiment
log preparation (B12-B16) and the billing schedule (B17)."""

from pyspark.sql import functions as F

from growlytics.operators import billing, experiment_log as XL, quality as Q
from growlytics.plans.oracle import r6
from growlytics.plans.registry import register

PROFILED = ("lineitem", "orders", "customer", "events")


TABLE_COLUMNS = {
    "lineitem": ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                 "l_returnflag l_linestatus l_shipdate"),
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "events": "event_id ts user_id event_type value props",
}


def _null_sql(t: str, c: str) -> str:
    return (f"SELECT '{t}' AS dataset, '{c}' AS column, count(*) AS row_count, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
            f"{r6(f'CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {c} IS NULL) / count(*) END')} AS null_rate "
            f"FROM {t}")


@register("b2_null_profile", sql="\nUNION ALL\n".join(
    _null_sql(t, c) for t in PROFILED for c in TABLE_COLUMNS[t].split()))
def b2_null_profile(ctx):
    out = None
    for t in PROFILED:
        part = Q.null_profile(ctx.table(t), t)
        out = part if out is None else out.unionByName(part)
    return out


@register("b3_dedupe", sql="\nUNION ALL\n".join(
    f"""SELECT '{name}' AS dataset, (SELECT count(*) FROM {src}) AS initial_rows,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS distinct_rows,
       (SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) AS duplicate_rows"""
    for name, src in (
        ("lineitem", "lineitem"),
        ("lineitem_keys", "(SELECT l_orderkey, l_linenumber FROM lineitem)"),
        ("orders", "orders"),
        ("events", "events"),
    )))
def b3_dedupe(ctx):
    li = ctx.table("lineitem")
    parts = [
        Q.duplicate_stats(li, "lineitem"),
        Q.duplicate_stats(li.select("l_orderkey", "l_linenumber"), "lineitem_keys"),
        Q.duplicate_stats(ctx.table("orders"), "orders"),
        Q.duplicate_stats(ctx.table("events"), "events"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("b3_fingerprint_dirty", sql="""
, d AS (SELECT l_orderkey % 97 AS k, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS flag, CASE WHEN l_linenumber % 3 = 0 THEN l_linestatus END AS status FROM lineitem)
SELECT 'lineitem' AS dataset, count(*) AS initial_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d)) AS duplicate_rows FROM d
""")
def b3_fingerprint_dirty(ctx):
    """B3 where most rows repeat and many hold nulls in different columns."""
    n = F.col("l_linenumber")
    rows = ctx.table("lineitem").select((F.col("l_orderkey") % 97).alias("k"), F.when(n % 2 == 0, F.col("l_returnflag")).alias("flag"),
                                        F.when(n % 3 == 0, F.col("l_linestatus")).alias("status"))
    return Q.duplicate_stats(rows, "lineitem")


@register("b4_clean_payments", sql="""
SELECT DISTINCT payment_id, user_id, round(CAST(amount AS DOUBLE), 6) AS amount, strftime(payment_date, '%Y-%m-%d') AS payment_date
FROM payments WHERE amount > 0
""")
def b4_clean_payments(ctx):
    return Q.clean(ctx.raw("payments"), "payments")


@register("b5_clean_users", sql="""
SELECT DISTINCT user_id, strftime(signup_date, '%Y-%m-%d') AS signup_date, coalesce(country, 'Unknown') AS country,
       acquisition_channel, coalesce(plan_type, 'Free') AS plan_type
FROM users
""")
def b5_clean_users(ctx):
    return Q.clean(ctx.raw("users"), "users")


# Dirty input by a fixed rule, written in both engines: repeated rows, amounts
# that are negative or missing, users without a country or a plan.
DIRTY = """,
dp AS (SELECT payment_id, user_id, CASE WHEN payment_id % 101 = 0 THEN -amount WHEN payment_id % 103 = 0 THEN NULL ELSE amount END AS amount,
              payment_date FROM payments),
dirty_payments AS (SELECT * FROM dp UNION ALL SELECT * FROM dp WHERE payment_id % 97 = 0),
du AS (SELECT user_id, signup_date, CASE WHEN user_id % 13 <> 0 THEN country END AS country, acquisition_channel,
              CASE WHEN user_id % 17 <> 0 THEN plan_type END AS plan_type FROM users),
dirty_users AS (SELECT * FROM du UNION ALL SELECT * FROM du WHERE user_id % 19 = 0)
"""


def _dirty(ctx, dataset: str):
    df = ctx.raw(dataset)
    if dataset == "payments":
        pid = F.col("payment_id")
        amount = F.when(pid % 101 == 0, -F.col("amount")).when(pid % 103 != 0, F.col("amount"))
        df = df.withColumn("amount", amount.cast(df.schema["amount"].dataType))
        return df.unionAll(df.where("payment_id % 97 = 0"))
    uid = F.col("user_id")
    df = df.withColumns({"country": F.when(uid % 13 != 0, F.col("country")), "plan_type": F.when(uid % 17 != 0, F.col("plan_type"))})
    return df.unionAll(df.where("user_id % 19 = 0"))


@register("a3_clean_payments", extra=DIRTY, sql="""
SELECT DISTINCT payment_id, user_id, round(CAST(amount AS DOUBLE), 6) AS amount, strftime(payment_date, '%Y-%m-%d') AS payment_date
FROM dirty_payments WHERE amount > 0
""")
def a3_clean_payments(ctx):
    """What the load keeps of dirty payments."""
    return Q.clean(_dirty(ctx, "payments"), "payments")


@register("a3_clean_users", extra=DIRTY, sql="""
SELECT DISTINCT user_id, strftime(signup_date, '%Y-%m-%d') AS signup_date, coalesce(country, 'Unknown') AS country,
       acquisition_channel, coalesce(plan_type, 'Free') AS plan_type
FROM dirty_users
""")
def a3_clean_users(ctx):
    """What the load keeps of dirty users."""
    return Q.clean(_dirty(ctx, "users"), "users")


@register("b2_null_dirty", extra=DIRTY, sql="\nUNION ALL\n".join(
    _null_sql(f"dirty_{t}", c).replace(f"'dirty_{t}'", f"'{t}'") for t, cols in (
        ("payments", "payment_id user_id amount payment_date"),
        ("users", "user_id signup_date country acquisition_channel plan_type")) for c in cols.split()))
def b2_null_dirty(ctx):
    """Null counts and rates of the dirty datasets (B2)."""
    return Q.null_profile(_dirty(ctx, "payments"), "payments").unionByName(Q.null_profile(_dirty(ctx, "users"), "users"))


@register("b7_quality_dirty", extra=DIRTY, sql="\nUNION ALL\n".join(
    f"""SELECT '{d}' AS dataset, i.n AS initial_row_count, f.n AS final_row_count, i.n - x.n AS duplicate_rows_removed,
       x.n - f.n AS validation_failures_removed
FROM (SELECT count(*) AS n FROM dirty_{d}) i, (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM dirty_{d})) x,
     (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM dirty_{d}) WHERE {rule}) f"""
    for d, rule in (("payments", "amount > 0"), ("users", "true"))))
def b7_quality_dirty(ctx):
    """The quality report on dirty input."""
    return Q.quality_report(_dirty(ctx, "payments"), "payments").unionByName(Q.quality_report(_dirty(ctx, "users"), "users"))


DATASETS = ("users", "sessions", "events", "subscriptions", "payments", "experiments")
_B7_SRC = {
    "users": "users", "sessions": "sessions",
    "events": "(SELECT event_id, user_id, ts AS event_time, event_type FROM events)",
    "subscriptions": "subscriptions", "payments": "payments", "experiments": "experiments",
}


@register("b7_quality", sql="\nUNION ALL\n".join(
    f"""SELECT '{d}' AS dataset, i.n AS initial_row_count, f.n AS final_row_count, i.n - x.n AS duplicate_rows_removed,
       i.n - f.n - (i.n - x.n) AS validation_failures_removed
FROM (SELECT count(*) AS n FROM {_B7_SRC[d]}) i,
     (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM {_B7_SRC[d]})) x,
     (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM {_B7_SRC[d]}) {"WHERE amount > 0" if d == "payments" else ""}) f"""
    for d in DATASETS))
def b7_quality(ctx):
    out = None
    for d in DATASETS:
        part = Q.quality_report(ctx.raw(d), d)
        out = part if out is None else out.unionByName(part)
    return out


@register("b8_unique", sql="""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY ALL HAVING count(*) > 1
""")
def b8_unique(ctx):
    return Q.unique_test(ctx.table("lineitem"), ["l_orderkey", "l_linenumber"])


@register("b10_relationships", sql="""
SELECT 'lineitem.l_orderkey' AS test, l_orderkey AS key, count(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL) GROUP BY ALL
UNION ALL
SELECT 'lineitem.l_partkey', l_partkey, count(*) FROM lineitem
WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL) GROUP BY ALL
UNION ALL
SELECT 'lineitem.l_suppkey', l_suppkey, count(*) FROM lineitem
WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL) GROUP BY ALL
UNION ALL
SELECT 'orders.o_custkey', o_custkey, count(*) FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL) GROUP BY ALL
""")
def b10_relationships(ctx):
    """Orphan child keys with their row counts (empty when all resolve)."""
    li, o = ctx.table("lineitem"), ctx.table("orders")
    specs = [
        ("lineitem.l_orderkey", li, "l_orderkey", o, "o_orderkey"),
        ("lineitem.l_partkey", li, "l_partkey", ctx.table("part"), "p_partkey"),
        ("lineitem.l_suppkey", li, "l_suppkey", ctx.table("supplier"), "s_suppkey"),
        ("orders.o_custkey", o, "o_custkey", ctx.table("customer"), "c_custkey"),
    ]
    out = None
    for name, child, key, parent, pk in specs:
        part = Q.orphan_key_counts(child, key, parent, pk).select(F.lit(name).alias("test"), "key", "n")
        out = part if out is None else out.unionByName(part)
    return out


@register("b11_accepted", sql="""
SELECT 'l_returnflag' AS column, CAST(l_returnflag AS VARCHAR) AS value, count(*) AS n FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N', 'R') GROUP BY ALL
UNION ALL
SELECT 'o_orderstatus', CAST(o_orderstatus AS VARCHAR), count(*) FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O') GROUP BY ALL
""")
def b11_accepted(ctx):
    """Values outside the accepted sets; orders carry a third status 'P'
    that the accepted list ('F', 'O') deliberately leaves out."""
    a = Q.accepted_values_failures(ctx.table("lineitem"), "l_returnflag", ["A", "N", "R"])
    b = Q.accepted_values_failures(ctx.table("orders"), "o_orderstatus", ["F", "O"])
    return a.select(F.lit("l_returnflag").alias("column"), "value", "n").unionByName(
        b.select(F.lit("o_orderstatus").alias("column"), "value", "n")
    )


SOURCE_TESTS_SQL = """
SELECT 'users' AS dataset, 'unique' AS test, 'user_id' AS column, (SELECT count(*) FROM (SELECT user_id FROM users WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1)) AS failures
UNION ALL
SELECT 'sessions' AS dataset, 'unique' AS test, 'session_id' AS column, (SELECT count(*) FROM (SELECT session_id FROM sessions WHERE session_id IS NOT NULL GROUP BY session_id HAVING count(*) > 1)) AS failures
UNION ALL
SELECT 'events' AS dataset, 'unique' AS test, 'event_id' AS column, (SELECT count(*) FROM (SELECT event_id FROM (SELECT event_id, user_id, ts AS event_time, event_type FROM events) WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1)) AS failures
UNION ALL
SELECT 'subscriptions' AS dataset, 'unique' AS test, 'subscription_id' AS column, (SELECT count(*) FROM (SELECT subscription_id FROM subscriptions WHERE subscription_id IS NOT NULL GROUP BY subscription_id HAVING count(*) > 1)) AS failures
UNION ALL
SELECT 'payments' AS dataset, 'unique' AS test, 'payment_id' AS column, (SELECT count(*) FROM (SELECT payment_id FROM payments WHERE payment_id IS NOT NULL GROUP BY payment_id HAVING count(*) > 1)) AS failures
UNION ALL
SELECT 'users', 'not_null', 'user_id', (SELECT count(*) FROM users WHERE user_id IS NULL)
UNION ALL
SELECT 'sessions', 'not_null', 'session_id', (SELECT count(*) FROM sessions WHERE session_id IS NULL)
UNION ALL
SELECT 'sessions', 'not_null', 'user_id', (SELECT count(*) FROM sessions WHERE user_id IS NULL)
UNION ALL
SELECT 'events', 'not_null', 'event_id', (SELECT count(*) FROM (SELECT event_id, user_id, ts AS event_time, event_type FROM events) WHERE event_id IS NULL)
UNION ALL
SELECT 'subscriptions', 'not_null', 'subscription_id', (SELECT count(*) FROM subscriptions WHERE subscription_id IS NULL)
UNION ALL
SELECT 'subscriptions', 'not_null', 'status', (SELECT count(*) FROM subscriptions WHERE status IS NULL)
UNION ALL
SELECT 'subscriptions', 'not_null', 'plan', (SELECT count(*) FROM subscriptions WHERE plan IS NULL)
UNION ALL
SELECT 'payments', 'not_null', 'payment_id', (SELECT count(*) FROM payments WHERE payment_id IS NULL)
UNION ALL
SELECT 'experiments', 'not_null', 'user_id', (SELECT count(*) FROM experiments WHERE user_id IS NULL)
UNION ALL
SELECT 'sessions', 'relationships', 'user_id', (SELECT count(*) FROM sessions x WHERE x.user_id IS NOT NULL AND x.user_id NOT IN (SELECT user_id FROM users WHERE user_id IS NOT NULL))
UNION ALL
SELECT 'experiments', 'relationships', 'user_id', (SELECT count(*) FROM experiments x WHERE x.user_id IS NOT NULL AND x.user_id NOT IN (SELECT user_id FROM users WHERE user_id IS NOT NULL))
UNION ALL
SELECT 'subscriptions', 'accepted_values', 'status', (SELECT count(DISTINCT status) FROM subscriptions WHERE status IS NOT NULL AND status NOT IN ('active', 'cancelled'))
UNION ALL
SELECT 'subscriptions', 'accepted_values', 'plan', (SELECT count(DISTINCT plan) FROM subscriptions WHERE plan IS NOT NULL AND plan NOT IN ('Free', 'Pro', 'Enterprise'))
"""


@register("b_source_tests", sql=SOURCE_TESTS_SQL)
def b_source_tests(ctx):
    """The declared source tests (B8-B11) on the six datasets: rows each
    test returns (duplicated values, null rows, orphan rows, bad values)."""
    profile = ctx.landed.profile(*DATASETS)
    return Q.source_tests({d: ctx.raw(d) for d in DATASETS}, profile)


LOG = """,
consistent AS (
  SELECT * FROM exp_log
  WHERE ("group" = 'control' AND landing_page = 'old_page') OR ("group" = 'treatment' AND landing_page = 'new_page')
),
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", exposure_id) AS rn FROM consistent) t
  WHERE rn = 1
),
mm AS (SELECT epoch_us(min("timestamp")) AS lo, epoch_us(max("timestamp")) AS hi FROM firsts),
scaled AS (
  SELECT f.*, CASE WHEN mm.hi - mm.lo > 0 THEN make_timestamp(CAST(round(
           epoch_us(TIMESTAMP '2025-06-22 00:00:00') + (epoch_us(f."timestamp") - mm.lo)
           * (CAST(epoch_us(TIMESTAMP '2026-06-22 00:00:00') - epoch_us(TIMESTAMP '2025-06-22 00:00:00') AS DOUBLE)
              / CAST(mm.hi - mm.lo AS DOUBLE))) AS BIGINT))
         ELSE TIMESTAMP '2025-06-22 00:00:00' END AS scaled_time
  FROM firsts f, mm
)
"""


@register("b12_consistent", extra=LOG, sql="""
SELECT user_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", "group", landing_page, converted, exposure_id
FROM consistent
""")
def b12_consistent(ctx):
    return XL.consistent_assignments(ctx.raw("experiment_log"))


@register("b13_keep_first", extra=LOG, sql="""
SELECT user_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", "group", landing_page, converted, exposure_id
FROM firsts
""")
def b13_keep_first(ctx):
    log = XL.consistent_assignments(ctx.raw("experiment_log"))
    return XL.keep_first(log, "user_id", ("timestamp",), "exposure_id")


@register("b14_sample", extra=LOG, sql="""
SELECT user_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", "group", landing_page, converted, exposure_id
FROM firsts ORDER BY md5(CAST(user_id AS VARCHAR) || '|42'), user_id LIMIT 1000
""")
def b14_sample(ctx):
    """Seeded sample of n users after B12 and B13."""
    log = XL.consistent_assignments(ctx.raw("experiment_log"))
    first = XL.keep_first(log, "user_id", ("timestamp",), "exposure_id")
    return XL.seeded_sample(first, ctx.p.sample_size, "user_id", ctx.p.seed)


@register("b14_sample_exact", extra=LOG, sql="""
SELECT user_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", "group", landing_page, converted, exposure_id
FROM firsts ORDER BY md5(CAST(user_id AS VARCHAR) || '|42'), user_id LIMIT (SELECT count(*) // 2 FROM firsts)
""")
def b14_sample_exact(ctx):
    """Half of the users, exactly, by a filter on hash prefixes."""
    log = XL.consistent_assignments(ctx.raw("experiment_log"))
    first = XL.keep_first(log, "user_id", ("timestamp",), "exposure_id")
    return XL.exact_sample(first, first.count() // 2, "user_id", ctx.p.seed, few=64)


@register("b15_rescale", extra=LOG, sql="""
SELECT user_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", "group", landing_page, converted, exposure_id,
       strftime(scaled_time, '%Y-%m-%d %H:%M:%S') AS scaled_time
FROM scaled
""")
def b15_rescale(ctx):
    return XL.prepare(ctx.raw("experiment_log"), ctx.p)


@register("b16_enrol", extra=LOG, sql="""
SELECT 'EXP_3ARM' AS experiment_id, CASE WHEN "group" = 'control' THEN 'Control' ELSE 'Variant' END AS variant,
       user_id, strftime(scaled_time, '%Y-%m-%d %H:%M:%S') AS assigned_date
FROM scaled WHERE scaled_time >= TIMESTAMP '2026-01-01 00:00:00'
""")
def b16_enrol(ctx):
    return XL.enrol(XL.prepare(ctx.raw("experiment_log"), ctx.p), ctx.p)


@register("b17_billing", sql=f"""
, sched AS (
  SELECT user_id, plan, CASE plan WHEN 'Pro' THEN 29.0 WHEN 'Enterprise' THEN 299.0 END AS price,
         least(DATE '2001-08-02', coalesce(end_date, DATE '2001-08-02')) - start_date AS span,
         start_date < DATE '2001-08-02' AS before_horizon
  FROM subscriptions WHERE plan IN ('Pro', 'Enterprise')
),
n AS (
  SELECT user_id, plan, price,
         CASE WHEN span > 0 THEN CAST(ceil(span / 30.0) AS BIGINT) WHEN before_horizon THEN 1 ELSE 0 END AS n
  FROM sched
),
exp AS (SELECT user_id, min(plan) AS plan, sum(n) AS expected_charges, sum(n * price) AS expected_amount
        FROM n WHERE n > 0 GROUP BY user_id),
got AS (SELECT user_id, count(*) AS paid_count, CAST(sum(amount) AS DOUBLE) AS paid_amount FROM fact_payments GROUP BY user_id)
SELECT coalesce(exp.user_id, got.user_id) AS user_id, exp.plan,
       CAST(coalesce(exp.expected_charges, 0) AS BIGINT) AS expected_charges,
       {r6('coalesce(exp.expected_amount, 0)')} AS expected_amount,
       coalesce(got.paid_count, 0) AS paid_count, {r6('coalesce(got.paid_amount, 0)')} AS paid_amount,
       {r6('coalesce(got.paid_amount, 0) - coalesce(exp.expected_amount, 0)')} AS amount_gap
FROM exp FULL OUTER JOIN got ON exp.user_id = got.user_id
""")
def b17_billing(ctx):
    wh = ctx.wh
    return billing.reconcile(wh.stg_subscriptions, wh.fact_payments, ctx.p)


NOT_NULL = (
    ("users", ("user_id",)),
    ("sessions", ("session_id", "user_id")),
    ("events", ("event_id",)),
    ("subscriptions", ("subscription_id", "status", "plan")),
    ("payments", ("payment_id",)),
    ("experiments", ("user_id",)),
)
_NN_SRC = dict(_B7_SRC)


@register("b9_not_null", sql="\nUNION ALL\n".join(
    f"SELECT '{d}' AS dataset, 'not_null' AS test, '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS failures "
    f"FROM {_NN_SRC[d]}"
    for d, cols in NOT_NULL for c in cols))
def b9_not_null(ctx):
    """B9 on the declared columns of the six datasets (failing rows), from
    the profile that the load's writes collected."""
    rows = [(r["dataset"], "not_null", r["column"], r["null_count"]) for r in ctx.landed.profile(*dict(NOT_NULL))
            if r["column"] in dict(NOT_NULL).get(r["dataset"], ())]
    return ctx.spark.createDataFrame(rows, "dataset string, test string, column string, failures bigint")


@register("b1_load_profile", sql="\nUNION ALL\n".join(
    f"SELECT '{d}' AS dataset, '{c}' AS column, count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"{r6(f'CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {c} IS NULL) / count(*) END')} AS null_rate FROM {_NN_SRC[d]}"
    for d, cols in (
        ("users", "user_id signup_date country acquisition_channel plan_type"),
        ("sessions", "session_id user_id session_start session_end device_type"),
        ("events", "event_id user_id event_time event_type"),
        ("subscriptions", "subscription_id user_id plan start_date end_date status"),
        ("payments", "payment_id user_id amount payment_date"),
        ("experiments", "experiment_id variant user_id assigned_date")) for c in cols.split()))
def b1_load_profile(ctx):
    """Rows and nulls of every column of the six datasets (B1, B2), as the
    load's writes counted them: no scan of the data."""
    rows = [(r["dataset"], r["column"], r["row_count"], r["null_count"], r["null_count"] / r["row_count"] if r["row_count"] else None)
            for r in ctx.landed.profile(*DATASETS)]
    return ctx.spark.createDataFrame(rows, "dataset string, column string, row_count bigint, null_count bigint, null_rate double")


@register("b10_orphans_hot", sql="""
, child AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN -1 WHEN l_orderkey % 50 = 1 THEN -l_orderkey ELSE l_orderkey END AS k FROM lineitem)
SELECT k AS key, count(*) AS n FROM child WHERE k NOT IN (SELECT o_orderkey FROM orders) GROUP BY k
""")
def b10_orphans_hot(ctx):
    """B10 where one orphan key holds a third of all child rows and others
    hold a few."""
    k = F.col("l_orderkey")
    child = ctx.table("lineitem").select(F.when(k % 3 == 0, -1).when(k % 50 == 1, -k).otherwise(k).alias("k"))
    return Q.orphan_key_counts(child, "k", ctx.table("orders"), "o_orderkey")


@register("a1_csv_users", sql="""
SELECT user_id, strftime(signup_date, '%Y-%m-%d') AS signup_date, country, acquisition_channel, plan_type FROM users
""")
def a1_csv_users(ctx):
    """A1 + A2 round trip: the users landing table written as a raw CSV file
    (header, text dates), scanned back with the fixed schema and NA tokens,
    and typed by staging (C1)."""
    from growlytics.operators import staging
    from growlytics.session import shared_path
    from growlytics.sources import files

    path = shared_path(ctx.spark, "csv", "users")
    files.write_raw_csv(ctx.raw("users"), path)
    raw = files.read_raw(ctx.spark, "users", path)
    return staging.stg_users(raw.withColumn("user_id", F.col("user_id").cast("bigint")))


@register("a8_experiment_log", extra=LOG, sql="""
SELECT user_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", "group", landing_page, converted FROM exp_log
""")
def a8_experiment_log(ctx):
    """The exposure log as a CSV file, scanned back with its schema and
    the timestamp parsed."""
    from growlytics.session import shared_path
    from growlytics.sources import files

    path = shared_path(ctx.spark, "csv", "experiment_log")
    log = ctx.raw("experiment_log").select("user_id", "timestamp", "group", "landing_page", "converted")
    files.write_raw_csv(log, path)
    back = files.read_experiment_log(ctx.spark, path)
    return back.withColumn("user_id", F.col("user_id").cast("bigint"))
