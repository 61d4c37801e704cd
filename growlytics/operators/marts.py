"""Marts D1-D7: the star schema.

Facts carry ``date_id`` (YYYYMMDD) and, when written, are partitioned by
``month_id`` so date cutoffs prune whole directories
(:func:`growlytics.sources.warehouse.write_warehouse`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growlytics.config import PLAN_IDS
from growlytics.functions.dates import date_id, lit_date


def dim_users(stg_users: DataFrame) -> DataFrame:
    """Rename channel and plan."""
    return stg_users.select(
        "user_id",
        "signup_date",
        "country",
        F.col("acquisition_channel").alias("channel"),
        F.col("plan_type").alias("current_plan"),
    )


def calendar(start: DataFrame | dt.date, end: dt.date | None = None,
             spark: SparkSession | None = None) -> DataFrame:
    """One row per day, inclusive.  ``start`` may be a one-row DataFrame with
    columns ``d0, d1`` (bounds derived from data) or a date with ``end``."""
    if isinstance(start, DataFrame):
        bounds = start
    else:
        bounds = spark.range(1).select(lit_date(start).alias("d0"), lit_date(end).alias("d1"))
    return bounds.select(F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("date_day"))


def dim_dates(days: DataFrame) -> DataFrame:
    """date_id, date, ISO week, month, quarter, year."""
    d = F.col("date_day")
    return days.select(
        date_id(d).alias("date_id"),
        d.alias("date"),
        F.weekofyear(d).alias("week"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
    )


def dim_dates_for_range(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return dim_dates(calendar(start, end, spark))


def dim_dates_from_activity(fact_sessions: DataFrame) -> DataFrame:
    """D2 over the months the activity spans (first day of the first month to
    the last day of the last month); a one-row aggregate feeds the sequence."""
    bounds = fact_sessions.agg(
        F.trunc(F.min("session_start"), "MM").alias("d0"),
        F.last_day(F.max("session_start")).alias("d1"),
    )
    return dim_dates(calendar(bounds))


def dim_plans(stg_subscriptions: DataFrame) -> DataFrame:
    """D3: distinct plans with their fixed ids (else 0)."""
    plan = F.col("plan")
    pid = F.lit(0)
    for name, i in reversed(PLAN_IDS):
        pid = F.when(plan == name, i).otherwise(pid)
    return stg_subscriptions.select("plan").distinct().select(plan.alias("plan_name"), pid.alias("plan_id"))


def dim_variants(stg_experiments: DataFrame) -> DataFrame:
    """D4."""
    return stg_experiments.select("user_id", "experiment_id", "variant", "assigned_date")


def fact_events(stg_events: DataFrame) -> DataFrame:
    """D5."""
    return stg_events.select(
        "event_id", "user_id", "event_type", date_id(F.col("event_time")).alias("date_id"), "event_time"
    )


def fact_payments(stg_payments: DataFrame) -> DataFrame:
    """D6."""
    return stg_payments.select(
        "payment_id", "user_id", "amount", date_id(F.col("payment_date")).alias("date_id"), "payment_date"
    )


def fact_sessions(stg_sessions: DataFrame) -> DataFrame:
    """Drops session_end, keeps the duration."""
    return stg_sessions.select(
        "session_id",
        "user_id",
        "session_duration_minutes",
        date_id(F.col("session_start")).alias("date_id"),
        "session_start",
        "device_type",
    )
