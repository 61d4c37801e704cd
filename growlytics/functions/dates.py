"""Date helpers shared by marts and metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_id(c: Column) -> Column:
    """YYYYMMDD as an integer (``to_char(d, 'YYYYMMDD')::integer``)."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def month_id(c: Column) -> Column:
    """YYYYMM as an integer; the partition column of the facts."""
    return F.date_format(c, "yyyyMM").cast("int")


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")


def lit_ts(d: dt.date | dt.datetime) -> Column:
    if not isinstance(d, dt.datetime):
        d = dt.datetime(d.year, d.month, d.day)
    return F.lit(d.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def whole_days_between(later: Column, earlier: Column) -> Column:
    """``extract(day from later - earlier)``: whole days, truncated toward zero."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return (micros / F.lit(86_400_000_000)).cast("bigint")


def month_index(later: Column, earlier: Column) -> Column:
    """Calendar-month difference (year * 12 + month)."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
