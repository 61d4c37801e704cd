"""The user-day activity mart: one row per user and calendar day.

Facts are reduced once, in the load, to mergeable states per (user_id, day):
counts, sums and maxima that add up over any set of days.  KPIs, segments,
cohorts and churn features then aggregate this table, which is bucketed by
user_id, so none of them shuffles a fact row again.  A user has at most one
row per day: however many rows a user has in the facts, a bucket stays even.

``sessions`` counts distinct session ids: a session id of a user is counted
on its first day only, so the daily counts add up to the exact distinct count
(also up to any cutoff day).  Rows without a user are not in the mart; rows
without a date are under the day NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growlytics.config import Params

COLUMNS = {
    "session_rows": "bigint", "sessions": "bigint", "last_start": "timestamp", "device_type": "string",
    "event_ids": "bigint", "searches": "bigint", "page_views": "bigint", "payments": "bigint", "amount": "decimal(28,2)",
}


def _shaped(df: DataFrame, day: str, **given) -> DataFrame:
    cols = [given.get(c, F.lit(None)).cast(t).alias(c) for c, t in COLUMNS.items()]
    return df.where(F.col("user_id").isNotNull()).select("user_id", F.to_date(F.col(day)).alias("day"), *cols)


def user_days(fact_sessions: DataFrame, fact_events: DataFrame, fact_payments: DataFrame, p: Params,
              buckets: int | None = None) -> DataFrame:
    """The rows of all facts in one partial aggregate and shuffle, by fixed-width
    states under (user, day, device); the devices of a day, strings whose
    maximum takes a sort, are merged last, on what is left.  With ``buckets``
    that is done where the bucketed table is written: rows are dealt by user.

    A user with a third of all rows sends one row per task, day and device."""
    firsts = fact_sessions.where(F.col("session_id").isNotNull()).groupBy("user_id", "session_id").agg(
        F.min("session_start").alias("first"))
    parts = [
        _shaped(fact_sessions, "session_start", session_rows=F.lit(1), last_start=F.col("session_start"), device_type=F.col("device_type")),
        _shaped(firsts, "first", sessions=F.lit(1)),
        _shaped(fact_events, "event_time", event_ids=F.col("event_id").isNotNull().cast("int"),
                searches=(F.col("event_type") == p.search_event).cast("int"),
                page_views=(F.col("event_type") == p.page_view_event).cast("int")),
        _shaped(fact_payments, "payment_date", payments=F.lit(1), amount=F.col("amount")),
    ]
    rows = merged(reduce(DataFrame.unionByName, parts), "user_id", "day", "device_type")
    return merged(rows if buckets is None else rows.repartition(buckets, "user_id"), "user_id", "day")


def merged(df: DataFrame, *keys: str) -> DataFrame:
    """The states of the rows of each key, merged."""
    aggs = []
    for c, t in COLUMNS.items():
        if c not in keys:
            aggs.append((F.max(c) if c in ("last_start", "device_type") else F.sum(c)).cast(t).alias(c))
    return df.groupBy(*keys).agg(*aggs)


def per_user(days: DataFrame) -> DataFrame:
    """The states of each user over all of the given days.  On the bucketed
    mart this needs no exchange."""
    return merged(days, "user_id")


def active(days: DataFrame) -> DataFrame:
    """(user_id, day) with a session."""
    return days.where("session_rows > 0").select("user_id", "day")
