"""Survival and predicted LTV: J1-J7 (Kaplan-Meier per plan).

Scale: subscriptions are first aggregated to (plan, tenure) — at most a few
thousand distinct tenures per plan whatever the number of subscriptions —
and only then do windows run, partitioned by plan.  The dense daily curve is
bounded by the 730-day cap, so every window after J1 sees small partitions.
A plan holding a third of all subscriptions is combined map-side by the
(plan, tenure) partial aggregate before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from growlytics.config import Params
from growlytics.session import checkpointed
from growlytics.functions.dates import lit_date


def price_col(p: Params, plan=None):
    plan = F.col("plan") if plan is None else plan
    expr = F.lit(None).cast("double")
    for name, price in reversed(p.plan_prices):
        expr = F.when(plan == name, F.lit(price)).otherwise(expr)
    return expr


def tenure(stg_subscriptions: DataFrame, p: Params) -> DataFrame:
    """Paid subscriptions with churned flag and tenure in days
    (cancelled: end - start; otherwise as-of - start)."""
    cancelled = F.col("status") == "cancelled"
    return stg_subscriptions.where(F.col("plan").isin(*p.paid_plans)).select(
        "plan",
        "status",
        "start_date",
        "end_date",
        cancelled.cast("int").alias("churned"),
        F.when(cancelled, F.datediff("end_date", "start_date"))
        .otherwise(F.datediff(lit_date(p.as_of), F.col("start_date")))
        .alias("tenure_days"),
    )


def negative_tenures(ten: DataFrame) -> DataFrame:
    """Per plan, how many tenures are below zero (an end before its start, or
    a start after the as-of date): they count in the life table as they are."""
    return ten.groupBy("plan").agg(F.count_if(F.col("tenure_days") < 0).alias("negative"), F.count_if(F.col("tenure_days").isNull()).alias("missing"))


def tenure_groups(ten: DataFrame) -> DataFrame:
    """(plan, tenure) -> deaths, total: the one aggregation every survival
    output derives from (NULL tenures kept as their own group, so row counts
    include them as the reference's do)."""
    return ten.groupBy("plan", "tenure_days").agg(
        F.sum("churned").cast("bigint").alias("deaths"), F.count(F.lit(1)).alias("total")
    )


def life_table(ten: DataFrame) -> DataFrame:
    """Per plan and tenure: deaths, total, at_risk (reverse cumulative
    total), hazard, survival (cumulative product of 1 - hazard)."""
    return life_table_from_groups(tenure_groups(ten))


def life_table_from_groups(groups: DataFrame) -> DataFrame:
    g = groups.where(F.col("tenure_days").isNotNull())
    desc = Window.partitionBy("plan").orderBy(F.desc("tenure_days")).rowsBetween(Window.unboundedPreceding, 0)
    asc = Window.partitionBy("plan").orderBy("tenure_days").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("at_risk", F.sum("total").over(desc))
    g = g.withColumn("hazard", F.coalesce(F.try_divide(F.col("deaths"), F.col("at_risk")), F.lit(0.0)))
    return g.withColumn("survival", F.product(1.0 - F.col("hazard")).over(asc))


def plan_stats(ten: DataFrame, lt: DataFrame, p: Params) -> DataFrame:
    """Per plan: rows, churns, exposure (sum of tenure) and the curve end
    ``max_day`` = min(max tenure, cap) (not below 0); derived from the same
    (plan, tenure) aggregate as the life table, so the subscriptions are
    aggregated once."""
    return plan_stats_from_groups(tenure_groups(ten), p)


def plan_stats_from_groups(groups: DataFrame, p: Params) -> DataFrame:
    s = groups.groupBy("plan").agg(
        F.sum("total").alias("n"),
        F.sum("deaths").cast("bigint").alias("churns"),
        F.sum(F.col("tenure_days") * F.col("total")).cast("double").alias("exposure"),
        F.max("tenure_days").alias("max_tenure"),
    )
    return s.withColumn(
        "max_day", F.greatest(F.least(F.coalesce("max_tenure", F.lit(0)), F.lit(p.tenure_cap)), F.lit(0))
    )


def daily_curve(lt: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per plan and day 0..max_day: survival forced to 1 at day
    0, forward-filled between observed tenures (1 before the first)."""
    days = stats.select("plan", "max_day", F.explode(F.sequence(F.lit(0), F.col("max_day"))).alias("day"))
    j = days.join(
        lt.select("plan", F.col("tenure_days").alias("day"), "survival"), ["plan", "day"], "left"
    )
    s0 = F.when(F.col("day") == 0, F.lit(1.0)).otherwise(F.col("survival"))
    w = Window.partitionBy("plan").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return j.select(
        "plan", "day", "max_day", F.coalesce(F.last(s0, ignorenulls=True).over(w), F.lit(1.0)).alias("survival")
    )


def lifetime(curve: DataFrame, stats: DataFrame, p: Params) -> DataFrame:
    """J4 + J5: expected lifetime (days, months), predicted LTV, counts."""
    c = curve.groupBy("plan").agg(
        F.sum("survival").alias("observed_days"),
        F.max_by("survival", "day").alias("last_survival"),
    )
    t = stats.join(c, "plan")
    has_churn = (F.col("exposure") > 0) & (F.col("churns") > 0)
    tail = F.col("last_survival") / (F.col("churns") / F.col("exposure"))
    days = F.when(has_churn, F.col("observed_days") + tail).otherwise(
        F.least(F.lit(p.no_churn_horizon), F.col("observed_days") + F.col("last_survival") * p.no_churn_horizon)
    )
    months = days / p.days_per_month
    return t.select(
        "plan",
        price_col(p).alias("price"),
        days.alias("expected_lifetime_days"),
        months.alias("expected_lifetime_months"),
        (price_col(p) * months).alias("ltv"),
        (F.col("n") - F.col("churns")).alias("active_users"),
        F.col("churns").alias("churned_users"),
        F.lit("observed").alias("source"),
    )


def sampled_curve(curve: DataFrame) -> DataFrame:
    """Every 10th day when the curve is shorter than 180 days, else every
    30th, plus the last day."""
    step = F.when(F.col("max_day") < 180, 10).otherwise(30)
    return curve.where((F.col("day") % step == 0) | (F.col("day") == F.col("max_day"))).select(
        "plan", "day", F.col("survival").alias("survival_rate")
    )


def _plan_config(spark: SparkSession, p: Params) -> DataFrame:
    return spark.createDataFrame(list(p.plan_prices), "plan string, price double")


def default_summary(spark: SparkSession, present: DataFrame, p: Params) -> DataFrame:
    """Plans of the price table without subscriptions get the fallback:
    LTV = price / monthly churn, lifetime = 1 / monthly churn months."""
    missing = _plan_config(spark, p).join(present.select("plan"), "plan", "left_anti")
    churn = p.fallback_monthly_churn
    return missing.select(
        "plan",
        "price",
        F.lit(p.days_per_month / churn).alias("expected_lifetime_days"),
        F.lit(1.0 / churn).alias("expected_lifetime_months"),
        (F.col("price") / churn).alias("ltv"),
        F.lit(0).cast("bigint").alias("active_users"),
        F.lit(0).cast("bigint").alias("churned_users"),
        F.lit("default").alias("source"),
    )


def default_curve(spark: SparkSession, present: DataFrame, p: Params) -> DataFrame:
    """J7 curve: 0.97^(d/30) for d = 0, 30, ..., 360."""
    missing = _plan_config(spark, p).join(present.select("plan"), "plan", "left_anti")
    d = F.explode(F.sequence(F.lit(0), F.lit(360), F.lit(30)))
    return missing.select("plan", d.alias("day")).select(
        "plan", "day", F.pow(F.lit(1.0 - p.fallback_monthly_churn), F.col("day") / 30.0).alias("survival_rate")
    )


def curve_parts(stg_subscriptions: DataFrame, p: Params) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Life table, per-plan stats and daily curve from one pass over the
    subscriptions: the (plan, tenure) aggregate (a few thousand rows per
    plan) is checkpointed eagerly into the shared checkpoint folder, and the
    several consumers below read it instead of re-aggregating."""
    groups = checkpointed(tenure_groups(tenure(stg_subscriptions, p)))
    lt = life_table_from_groups(groups)
    stats = plan_stats_from_groups(groups, p)
    return lt, stats, daily_curve(lt, stats)


def survival_ltv(stg_subscriptions: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """Summary per plan (J4/J5, J7) and sampled curves."""
    spark = stg_subscriptions.sparkSession
    lt, stats, curve = curve_parts(stg_subscriptions, p)
    summary = lifetime(curve, stats, p)
    present = stats.select("plan")
    return (
        summary.unionByName(default_summary(spark, present, p)),
        sampled_curve(curve).unionByName(default_curve(spark, present, p)),
    )
