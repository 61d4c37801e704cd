"""Cohort retention G1-G5.

Activity is reduced to distinct (user, period) before it meets the user
table, so the join input is bounded by users x periods no matter how many
sessions a user has; the join is on ``user_id`` (shuffle-hash / sort-merge
chosen by Catalyst, AQE splits a skewed user partition).  Cohort sizes are a
small aggregate (one row per cohort) joined back.

Grain: ``month`` (default, index = year * 12 + month difference), ``week``
(index in whole weeks between week starts) or ``day``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _period(c: Column, grain: str) -> Column:
    if grain == "month":
        return F.trunc(c, "MM")
    if grain == "week":
        return F.date_trunc("week", c).cast("date")
    if grain == "day":
        return F.to_date(c)
    raise ValueError(f"unknown grain {grain!r}")


def _index(later: Column, earlier: Column, grain: str) -> Column:
    if grain == "month":
        return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
    if grain == "week":
        return (F.datediff(later, earlier) / 7).cast("int")
    return F.datediff(later, earlier)


def cohort_sizes(users: DataFrame, grain: str = "month", signup_col: str = "signup_date") -> DataFrame:
    """G1: distinct users per signup period."""
    return users.groupBy(_period(F.col(signup_col), grain).alias("cohort")).agg(
        F.count_distinct("user_id").alias("cohort_size")
    )


def user_periods(activity: DataFrame, ts_col: str, grain: str = "month") -> DataFrame:
    """Distinct (user, activity period)."""
    return (
        activity.where(F.col("user_id").isNotNull())
        .select("user_id", _period(F.col(ts_col), grain).alias("period"))
        .distinct()
    )


def retention(users: DataFrame, activity: DataFrame, ts_col: str = "session_start", grain: str = "month",
              signup_col: str = "signup_date") -> DataFrame:
    """G3 + G4 in long form: cohort, cohort_index, active_users, cohort_size,
    retention_rate; only index >= 0; missing cells are absent (as coded)."""
    # (user, cohort) and (user, period) are both distinct, and the index is
    # injective in the period for a fixed cohort, so each (cohort, index)
    # cell holds a user at most once: count(*) equals count(distinct user)
    # and needs one partially aggregated shuffle instead of two
    uc = users.where(F.col("user_id").isNotNull()).select(
        "user_id", _period(F.col(signup_col), grain).alias("cohort")
    ).distinct()
    act = user_periods(activity, ts_col, grain)
    counts = (
        uc.join(act, "user_id")
        .select("cohort", _index(F.col("period"), F.col("cohort"), grain).alias("cohort_index"))
        .groupBy("cohort", "cohort_index")
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
    sizes = cohort_sizes(users, grain, signup_col)
    rate = F.when(F.col("cohort_size") > 0, F.col("active_users") / F.col("cohort_size")).otherwise(0.0)
    return (
        counts.join(sizes, "cohort")
        .where(F.col("cohort_index") >= 0)
        .select("cohort", "cohort_index", "active_users", "cohort_size", rate.alias("retention_rate"))
        .orderBy("cohort", "cohort_index")
    )


def cohort_label(c: Column, grain: str) -> Column:
    return F.date_format(c, "yyyy-MM") if grain == "month" else F.date_format(c, "yyyy-MM-dd")


def retention_matrix(long: DataFrame) -> DataFrame:
    """One record per cohort with a map index -> rate (index ascending).

    The collected list per cohort has one entry per activity period after
    the cohort (bounded by the calendar, not by the number of users)."""
    return long.groupBy("cohort", "cohort_size").agg(
        F.map_from_entries(
            F.array_sort(F.collect_list(F.struct(F.col("cohort_index"), F.col("retention_rate"))))
        ).alias("retention_rates")
    )


def render_rates(m: Column, digits: int = 6) -> Column:
    """A map index -> rate as text 'i:rate,...' (index ascending)."""
    entries = F.array_sort(F.map_entries(m))
    return F.concat_ws(
        ",",
        F.transform(entries, lambda e: F.format_string(f"%d:%.{digits}f", e["key"], e["value"])),
    )
