"""Documented revenue and churn by month: E15-E17.

A paid subscription is active at the start of month m0 when
``start < m0 and (end is null or end >= m0)``.  Rather than a range join of
every subscription against every month, each subscription contributes +1
(and +price) at the first month start after it begins,
``add_months(trunc(start), 1)``, and -1 (-price) at
``greatest(that, add_months(trunc(end), 1))``; summing the deltas per month
(partial aggregation) and taking a running sum over the month calendar gives
the active count and MRR at every month start.  The only window is over the
calendar (one row per month).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.functions.dates import lit_date
from growlytics.operators.survival import price_col


def month_calendar(stg_subscriptions: DataFrame, p: Params) -> DataFrame:
    """Month starts from the first paid start month to the as-of month."""
    paid = stg_subscriptions.where(F.col("plan").isin(*p.paid_plans))
    b = paid.agg(F.trunc(F.min("start_date"), "MM").alias("m0")).select(
        "m0", F.trunc(lit_date(p.as_of), "MM").alias("m1")
    )
    return b.select(F.explode(F.sequence("m0", "m1", F.expr("INTERVAL 1 MONTH"))).alias("month"))


def monthly_subscriptions(stg_subscriptions: DataFrame, p: Params) -> DataFrame:
    """Per month start: active paid subscriptions, MRR of their plan prices,
    cancellations during the month and the churn rate (E15, E16)."""
    paid = stg_subscriptions.where(F.col("plan").isin(*p.paid_plans)).select(
        "start_date", "end_date", "status", price_col(p).alias("price")
    )
    on = F.add_months(F.trunc("start_date", "MM"), 1)
    off = F.greatest(on, F.add_months(F.trunc("end_date", "MM"), 1))
    events = F.array(
        F.struct(on.alias("month"), F.lit(1).alias("d_active"), F.col("price").alias("d_mrr"), F.lit(0).alias("cancel")),
        F.struct(
            off.alias("month"),
            F.lit(-1).alias("d_active"),
            (-F.col("price")).alias("d_mrr"),
            F.lit(0).alias("cancel"),
        ),
        F.struct(
            F.trunc("end_date", "MM").alias("month"),
            F.lit(0).alias("d_active"),
            F.lit(0.0).alias("d_mrr"),
            F.lit(1).alias("cancel"),
        ),
    )
    # keep the -1 only for subscriptions that end, the cancellation only
    # when the subscription was cancelled
    ev = paid.select(F.explode(events).alias("e"), "end_date", "status").where(
        (F.col("e.d_active") >= 0) | F.col("end_date").isNotNull()
    ).where((F.col("e.cancel") == 0) | ((F.col("status") == "cancelled") & F.col("end_date").isNotNull()))
    per_month = ev.groupBy(F.col("e.month").alias("month")).agg(
        F.sum("e.d_active").alias("d_active"), F.sum("e.d_mrr").alias("d_mrr"), F.sum("e.cancel").alias("cancellations")
    )
    run = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    j = month_calendar(stg_subscriptions, p).join(per_month, "month", "left").na.fill(
        {"d_active": 0, "d_mrr": 0.0, "cancellations": 0}
    )
    out = j.select(
        "month",
        F.sum("d_active").over(run).cast("bigint").alias("active_start"),
        F.sum("d_mrr").over(run).alias("mrr"),
        F.col("cancellations").cast("bigint").alias("cancellations"),
    )
    return out.withColumn("churn_rate", F.try_divide(F.col("cancellations") * 100.0, F.col("active_start")))


def monthly_active(fact_sessions: DataFrame) -> DataFrame:
    return fact_sessions.where(F.col("user_id").isNotNull()).groupBy(
        F.trunc("session_start", "MM").alias("month")
    ).agg(F.count_distinct("user_id").alias("mau"))


def monthly_ltv(stg_subscriptions: DataFrame, fact_sessions: DataFrame, p: Params) -> DataFrame:
    """ARPU = MRR / MAU (MAU = distinct users with a session in the
    month) and LTV = ARPU / monthly churn rate, per month."""
    m = monthly_subscriptions(stg_subscriptions, p)
    j = m.join(monthly_active(fact_sessions), "month", "left").na.fill({"mau": 0})
    arpu = F.try_divide(F.col("mrr"), F.col("mau"))
    return j.select(
        "month",
        "mrr",
        F.col("mau").cast("bigint").alias("mau"),
        arpu.alias("arpu"),
        "churn_rate",
        F.try_divide(arpu, F.col("churn_rate") / 100.0).alias("ltv"),
    )
