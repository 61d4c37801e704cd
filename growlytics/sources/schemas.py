"""Explicit schemas of the raw datasets.

Raw files carry dates and timestamps as text and ``amount`` as a plain
number; the staging layer casts them.  Ids are strings in files; operators
never assume a particular id type (the test binding uses bigint ids).
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


RAW_SCHEMAS: dict[str, StructType] = {
    "users": StructType(_strings("user_id", "signup_date", "country", "acquisition_channel", "plan_type")),
    "sessions": StructType(_strings("session_id", "user_id", "session_start", "session_end", "device_type")),
    "events": StructType(_strings("event_id", "user_id", "event_time", "event_type")),
    "subscriptions": StructType(
        _strings("subscription_id", "user_id", "plan", "start_date", "end_date", "status")
    ),
    "payments": StructType(
        _strings("payment_id", "user_id") + [StructField("amount", DoubleType(), True)] + _strings("payment_date")
    ),
    "experiments": StructType(_strings("experiment_id", "variant", "user_id", "assigned_date")),
}

# External experiment log (one row per exposure).
EXPERIMENT_LOG_SCHEMA = StructType(
    _strings("user_id", "timestamp", "group", "landing_page") + [StructField("converted", IntegerType(), True)]
)

# Streamed event payload (L1): event_id and event_time may be absent.
TRACK_SCHEMA = StructType(_strings("event_id", "user_id", "event_type", "event_time"))

DATASETS = tuple(RAW_SCHEMAS)

# Default NA tokens of the reference's CSV reader (pandas defaults); all of
# them read as NULL.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
