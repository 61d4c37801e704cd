"""KPI aggregates E1-E10 (as coded by the reference dashboard).

Shape of every operator: per-user (or per-key) partial aggregate first, then
a global one-row aggregate.  Three ``count(distinct case ...)`` would make
Spark ``Expand`` each row three times; reducing to one row per user with
``max(session_start)`` and counting users past each cutoff is exact and
needs one shuffle on ``user_id`` whose map side already combines hot users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.functions.dates import lit_date, lit_ts, month_label


def total_users(dim_users: DataFrame) -> DataFrame:
    """E1."""
    return dim_users.agg(F.count(F.lit(1)).alias("total_users"))


def active_users(user_days: DataFrame, p: Params) -> DataFrame:
    """``mau`` = distinct users over all time (as coded), ``wau`` / ``dau``
    = distinct users with a session on or after the cutoffs; from the user-day
    mart, without an exchange of its rows."""
    last = user_days.where("session_rows > 0").groupBy("user_id").agg(F.max("last_start").alias("last_start"))
    return last.agg(
        F.count(F.lit(1)).alias("mau"),
        F.count_if(F.col("last_start") >= lit_ts(p.wau_cutoff)).alias("wau"),
        F.count_if(F.col("last_start") >= lit_ts(p.dau_cutoff)).alias("dau"),
    )


def mrr(fact_payments: DataFrame, p: Params) -> DataFrame:
    """Payments since the cutoff (NULL -> 0) and x12.  The predicate on
    ``payment_date`` reaches the scan (and prunes month partitions of a
    written fact table)."""
    s = fact_payments.where(F.col("payment_date") >= lit_date(p.mrr_cutoff)).agg(
        F.coalesce(F.sum("amount").cast("double"), F.lit(0.0)).alias("mrr")
    )
    return s.select("mrr", (F.col("mrr") * 12).alias("arr"))


def paid_churn(stg_subscriptions: DataFrame, p: Params) -> DataFrame:
    """E5: cancelled paid subscriptions / all paid subscriptions x 100."""
    s = stg_subscriptions.where(F.col("plan").isin(*p.paid_plans)).agg(
        F.count_if(F.col("status") == "cancelled").alias("churned"),
        F.count(F.lit(1)).alias("total_paid"),
    )
    rate = F.when(F.col("total_paid") > 0, F.col("churned") / F.col("total_paid") * 100).otherwise(0.0)
    return s.select("churned", "total_paid", rate.alias("churn_rate"))


def _paid_per_user(user_days: DataFrame) -> DataFrame:
    """One row per paying user, from the mart that is bucketed by user."""
    return user_days.where("payments > 0").groupBy("user_id").agg(F.sum("amount").cast("decimal(28,2)").alias("amount"))


def revenue_by_plan(user_days: DataFrame, stg_subscriptions: DataFrame) -> DataFrame:
    """Payments x subscriptions on user, summed by plan.  As coded, a user
    with several subscriptions counts each payment once per subscription;
    summing payments per user first gives the same totals with a join input
    of one row per paying user."""
    subs = stg_subscriptions.select("user_id", "plan")
    return (
        _paid_per_user(user_days).join(subs, "user_id")
        .groupBy(F.col("plan").alias("label"))
        .agg(F.sum("amount").alias("value"))
    )


def revenue_by_channel(user_days: DataFrame, dim_users: DataFrame) -> DataFrame:
    """Payments x users, summed by acquisition channel.

    Pre-aggregating payments per user before the join keeps the join input
    at one row per paying user whatever the payment history length."""
    return (
        _paid_per_user(user_days).join(dim_users.select("user_id", "channel"), "user_id")
        .groupBy(F.col("channel").alias("label"))
        .agg(F.sum("amount").alias("value"))
    )


def kpi_summary(wh, p: Params, with_breakdowns: bool = False) -> DataFrame:
    """E9 (with E4 ARPU and E6 LTV): one record of all KPIs.

    The parts are one-row aggregates, combined with cross joins of single
    rows; the plan / channel breakdowns (small: one row per plan or channel)
    are attached as arrays of structs when requested.
    """
    row = (
        total_users(wh.dim_users)
        .crossJoin(active_users(wh.user_days, p))
        .crossJoin(mrr(wh.fact_payments, p))
        .crossJoin(paid_churn(wh.stg_subscriptions, p).select("churn_rate"))
    )
    arpu = F.when(F.col("mau") > 0, F.col("mrr") / F.col("mau")).otherwise(0.0)
    row = row.withColumn("arpu", arpu)
    monthly = F.col("churn_rate") / 100.0 / 12.0
    ltv = F.when(monthly > 0, F.col("arpu") / monthly).otherwise(F.col("arpu") * 24)
    row = row.withColumn("ltv", ltv).select(
        "total_users", "dau", "wau", "mau", "mrr", "arr", "arpu", "churn_rate", "ltv"
    )
    if with_breakdowns:
        def nest(df: DataFrame, name: str) -> DataFrame:
            return df.agg(
                F.array_sort(F.collect_list(F.struct("label", F.col("value").cast("double").alias("value")))).alias(name)
            )

        row = row.crossJoin(nest(revenue_by_plan(wh.user_days, wh.stg_subscriptions), "plan_revenue"))
        row = row.crossJoin(nest(revenue_by_channel(wh.user_days, wh.dim_users), "channel_revenue"))
    return row


def monthly_active_users(user_days: DataFrame) -> DataFrame:
    """Distinct users per calendar month ('yyyy-MM'), ordered.

    (user, month) pairs are made distinct inside the user's bucket; what is
    shuffled are counts per month."""
    pairs = user_days.where("session_rows > 0").groupBy("user_id", month_label(F.col("day")).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("month").agg(F.count(F.lit(1)).alias("active_users")).orderBy("month")
