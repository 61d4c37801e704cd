"""RFM segmentation H1-H3.

H1 merges the user-day mart per user (no fact row is read) and joins it onto
``dim_users``; both tables are bucketed by ``user_id``, so neither the
aggregate nor the join needs an exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growlytics.config import SEGMENT_NAMES, Params
from growlytics.functions.dates import lit_ts, whole_days_between
from growlytics.operators import user_days as days


def rfm_features(dim_users: DataFrame, user_days: DataFrame, p: Params) -> DataFrame:
    """H1: recency (whole days as-of minus last session, default 365),
    frequency (distinct sessions, 0), monetary (sum of payments, 0)."""
    per = days.per_user(user_days.select("user_id", *days.COLUMNS))
    recency = whole_days_between(lit_ts(p.as_of), F.col("last_start"))
    return (
        dim_users.select("user_id", "current_plan")
        .join(per.select("user_id", recency.alias("recency"), "sessions", "amount"), "user_id", "left")
        .select(
            "user_id",
            "current_plan",
            F.coalesce("recency", F.lit(p.missing_recency).cast("bigint")).alias("recency"),
            F.coalesce("sessions", F.lit(0).cast("bigint")).alias("frequency"),
            F.coalesce(F.col("amount"), F.lit(0).cast("decimal(28,2)")).alias("monetary"),
        )
    )


def segment_rule(plan: Column, r: Column, f: Column, p: Params) -> Column:
    """H2: first match wins, all bounds strict; monetary never decides."""
    paid = plan.isin(*p.paid_plans)
    (champ, power, loyal, at_risk, dormant, engaged, average) = SEGMENT_NAMES
    return (
        F.when((plan == "Enterprise") & (r < p.champion_recency), champ)
        .when((r < p.power_recency) & (f > p.power_frequency), power)
        .when((r < p.loyal_recency) & paid, loyal)
        .when((r > p.at_risk_recency) & paid, at_risk)
        .when(r > p.dormant_recency, dormant)
        .when((plan == "Free") & (f > p.engaged_free_frequency), engaged)
        .otherwise(average)
    )


def assign_segments(rfm: DataFrame, p: Params) -> DataFrame:
    """H2 on an H1 table."""
    return rfm.withColumn(
        "segment", segment_rule(F.col("current_plan"), F.col("recency"), F.col("frequency"), p)
    )


def segment_summary(segmented: DataFrame) -> DataFrame:
    """H3: count and mean R, F, M per segment, largest first."""
    return (
        segmented.groupBy("segment")
        .agg(
            F.count("user_id").alias("user_count"),
            F.avg("recency").alias("avg_recency"),
            F.avg("frequency").alias("avg_frequency"),
            F.avg(F.col("monetary").cast("double")).alias("avg_monetary"),
        )
        .orderBy(F.desc("user_count"), "segment")
    )


def rfm_segments(wh, p: Params) -> DataFrame:
    """H1 -> H2 -> H3 on a warehouse."""
    rfm = rfm_features(wh.dim_users, wh.user_days, p)
    return segment_summary(assign_segments(rfm, p))
