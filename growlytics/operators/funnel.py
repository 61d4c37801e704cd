"""Funnel and conversion: F1, F2, E13, E14.

F1 is as coded: independent distinct-user counts per step, no order or time
constraint between steps.  Steps are a parameter ``[(label, [event types])]``
and optional ``by`` columns (e.g. the event day) split the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growlytics.config import Params


def _step_labels(event_type: Column, steps) -> Column:
    """Array of the step labels an event type belongs to (usually 0 or 1)."""
    return F.filter(
        F.array(*[F.when(event_type.isin(*types), F.lit(label)) for label, types in steps]),
        lambda x: x.isNotNull(),
    )


def event_funnel(fact_events: DataFrame, p: Params, by: dict[str, Column] | None = None) -> DataFrame:
    """F1 in long form: (by..., step, users).

    Events outside every step are filtered before the shuffle; each event
    becomes (by, step, user), and ``count(distinct user)`` per (by, step)
    runs as a two-level aggregate (distinct (by, step, user) first), which a
    hot user cannot skew.  Steps with no users appear with 0 for each
    ``by`` group that has any step event.
    """
    by = by or {}
    types = sorted({t for _, ts in p.funnel_steps for t in ts})
    ev = fact_events.where(F.col("event_type").isin(*types) & F.col("user_id").isNotNull())
    by_names = list(by)
    tagged = ev.select(
        *[c.alias(n) for n, c in by.items()],
        "user_id",
        F.explode(_step_labels(F.col("event_type"), p.funnel_steps)).alias("step"),
    )
    counts = tagged.groupBy(*by_names, "step").agg(F.count_distinct("user_id").alias("users"))
    labels = F.array(*[F.lit(label) for label, _ in p.funnel_steps])
    if by_names:
        groups = counts.select(*by_names).distinct()
    else:
        groups = counts.sparkSession.range(1).select()
    grid = groups.select(*by_names, F.explode(labels).alias("step"))
    return grid.join(counts, [*by_names, "step"], "left").select(
        *by_names, "step", F.coalesce("users", F.lit(0).cast("bigint")).alias("users")
    )


def funnel_by_day(fact_events: DataFrame, p: Params) -> DataFrame:
    """F1 split by event day (an unfiltered funnel over all time is constant on
    the test binding, since every user has every event type)."""
    return event_funnel(fact_events, p, by={"day": F.to_date("event_time")})


def conversion_by_channel(dim_users: DataFrame, stg_subscriptions: DataFrame, p: Params) -> DataFrame:
    """users, users with a paid subscription and rate % per channel.

    Subscriptions are reduced to one ``bool_or(paid)`` row per user before the
    left join, so the join cannot fan out."""
    paid = stg_subscriptions.groupBy("user_id").agg(F.bool_or(F.col("plan").isin(*p.paid_plans)).alias("paid"))
    j = dim_users.where(F.col("user_id").isNotNull()).select("user_id", "channel").join(paid, "user_id", "left")
    # paid is one value per user, so distinct (channel, user, paid) rows make
    # count(*) / count_if exact distinct-user counts; two count(distinct)
    # aggregates would make Spark Expand every row twice
    agg = j.select("channel", "user_id", "paid").distinct().groupBy("channel").agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_if(F.col("paid")).alias("paid_conversions"),
    )
    rate = F.when(F.col("total_users") > 0, F.col("paid_conversions") / F.col("total_users") * 100).otherwise(0.0)
    return agg.withColumn("conversion_rate", rate)


def landing_to_signup(fact_events: DataFrame, p: Params) -> DataFrame:
    """E13 (documented): users with a signup / users with a landing view x 100."""
    flags = (
        fact_events.where(F.col("user_id").isNotNull() & F.col("event_type").isin(p.landing_event, p.signup_event))
        .groupBy("user_id")
        .agg(
            F.bool_or(F.col("event_type") == p.landing_event).alias("landed"),
            F.bool_or(F.col("event_type") == p.signup_event).alias("signed"),
        )
    )
    s = flags.agg(F.count_if("landed").alias("landing_users"), F.count_if("signed").alias("signup_users"))
    return s.withColumn("conversion_rate", F.try_divide(F.col("signup_users") * 100.0, F.col("landing_users")))


def signup_to_upgrade(dim_users: DataFrame, stg_subscriptions: DataFrame, p: Params) -> DataFrame:
    """E14 (documented): registered users with a paid subscription / registered x 100."""
    paid = stg_subscriptions.where(F.col("plan").isin(*p.paid_plans)).select("user_id").distinct()
    j = dim_users.select("user_id").join(paid.withColumn("paid", F.lit(True)), "user_id", "left")
    s = j.agg(
        F.count(F.lit(1)).alias("registered_users"),
        F.count_if(F.col("paid")).alias("paid_users"),
    )
    return s.withColumn("upgrade_rate", F.try_divide(F.col("paid_users") * 100.0, F.col("registered_users")))
