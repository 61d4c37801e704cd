"""Billing schedule B17: expected 30-day charges per paid subscription,
reconciled with the payments actually recorded.

Charges fall on start + 30 k days (k >= 0) strictly before the horizon
(as-of) and before the end date of a cancelled subscription; the first
charge on the start date is always due when the start precedes the
horizon.  The schedule is generated per row with ``sequence`` (bounded by
the subscription's own length), summed per user, and full-outer joined with
the per-user payment totals: both join sides are one row per user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.functions.dates import lit_date
from growlytics.operators.survival import price_col


def _charges(stg_subscriptions: DataFrame, p: Params) -> DataFrame:
    """Paid subscriptions with their number of due charges ``n``:
    k = 0 .. n-1 with start + 30 k < min(horizon, end); at least the first
    charge when the start precedes the horizon."""
    horizon = lit_date(p.as_of)
    bound = F.least(horizon, F.coalesce(F.col("end_date"), horizon))
    span = F.datediff(bound, F.col("start_date"))
    n = F.when(span > 0, F.ceil(span / p.billing_days)).when(F.col("start_date") < horizon, 1).otherwise(0)
    return stg_subscriptions.where(F.col("plan").isin(*p.paid_plans)).select(
        "user_id", "plan", "start_date", n.cast("int").alias("n"), price_col(p).alias("price")
    )


def schedule(stg_subscriptions: DataFrame, p: Params) -> DataFrame:
    """One row per expected charge: user_id, plan, charge_date, amount
    (bounded by each subscription's own length)."""
    k = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    return _charges(stg_subscriptions, p).where(F.col("n") > 0).select(
        "user_id", "plan", "start_date", "price", k.alias("k")
    ).select(
        "user_id",
        "plan",
        F.date_add("start_date", F.col("k") * p.billing_days).alias("charge_date"),
        F.col("price").alias("amount"),
    )


def reconcile(stg_subscriptions: DataFrame, fact_payments: DataFrame, p: Params) -> DataFrame:
    """Expected charges and amount vs recorded payments, per user.  The
    expected side needs no explode: per subscription it is n charges of the
    plan price."""
    exp = _charges(stg_subscriptions, p).where(F.col("n") > 0).groupBy("user_id").agg(
        F.min("plan").alias("plan"),
        F.sum("n").cast("bigint").alias("expected_charges"),
        F.sum(F.col("n") * F.col("price")).alias("expected_amount"),
    )
    got = fact_payments.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("paid_count"), F.sum("amount").cast("double").alias("paid_amount")
    )
    j = exp.join(got, "user_id", "full_outer")
    return j.select(
        "user_id",
        "plan",
        F.coalesce("expected_charges", F.lit(0).cast("bigint")).alias("expected_charges"),
        F.coalesce("expected_amount", F.lit(0.0)).alias("expected_amount"),
        F.coalesce("paid_count", F.lit(0)).alias("paid_count"),
        F.coalesce("paid_amount", F.lit(0.0)).alias("paid_amount"),
        (F.coalesce("paid_amount", F.lit(0.0)) - F.coalesce("expected_amount", F.lit(0.0))).alias("amount_gap"),
    )
