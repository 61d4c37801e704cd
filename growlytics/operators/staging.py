"""Staging projections C1-C6: typed views over the raw datasets.

Each is a single ``Project``: Catalyst inlines it into whatever reads it, so
a staging view costs nothing.  Casts are no-ops when the column already has
the target type (the test binding delivers typed columns; CSV delivers text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def as_date(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return F.to_date(c) if _is_text(df, name) else c.cast("date")


def as_timestamp(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return F.to_timestamp(c) if _is_text(df, name) else c.cast("timestamp")


def open_end_date(df: DataFrame, name: str) -> Column:
    """B6: '' (or blank) means open-ended -> NULL; otherwise a date."""
    if _is_text(df, name):
        return F.to_date(F.nullif(F.trim(F.col(name)), F.lit("")))
    return F.col(name).cast("date")


def stg_users(raw: DataFrame) -> DataFrame:
    """C1."""
    return raw.select(
        "user_id",
        as_date(raw, "signup_date").alias("signup_date"),
        "country",
        "acquisition_channel",
        "plan_type",
    )


def stg_sessions(raw: DataFrame) -> DataFrame:
    """duration = epoch(end - start) / 60 as double minutes."""
    start = as_timestamp(raw, "session_start")
    end = as_timestamp(raw, "session_end")
    return raw.select(
        "session_id",
        "user_id",
        start.alias("session_start"),
        end.alias("session_end"),
        "device_type",
        ((F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000.0)).alias(
            "session_duration_minutes"
        ),
    )


def stg_events(raw: DataFrame) -> DataFrame:
    """C3."""
    return raw.select("event_id", "user_id", as_timestamp(raw, "event_time").alias("event_time"), "event_type")


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    """C4: dates typed, '' end date -> NULL."""
    return raw.select(
        "subscription_id",
        "user_id",
        "plan",
        as_date(raw, "start_date").alias("start_date"),
        open_end_date(raw, "end_date").alias("end_date"),
        "status",
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    """Amount as decimal(18,2)."""
    return raw.select(
        "payment_id",
        "user_id",
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        as_date(raw, "payment_date").alias("payment_date"),
    )


def stg_experiments(raw: DataFrame) -> DataFrame:
    """C6."""
    return raw.select("experiment_id", "variant", "user_id", as_timestamp(raw, "assigned_date").alias("assigned_date"))


STAGING = {
    "users": stg_users,
    "sessions": stg_sessions,
    "events": stg_events,
    "subscriptions": stg_subscriptions,
    "payments": stg_payments,
    "experiments": stg_experiments,
}
