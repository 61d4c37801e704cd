"""Presentation at the edge of a registered query.

Operators return natural types (dates, timestamps, decimals, doubles); the
registered queries normalise them so the DuckDB oracle can produce identical
values: dates as ``yyyy-MM-dd``, timestamps as ``yyyy-MM-dd HH:mm:ss``,
decimals and doubles as doubles rounded to 6 places, small ints as bigint.
The oracle SQL applies the same rules by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def edge(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
