"""Time expressions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def time_literal(value: str | date | datetime, kind: T.DataType) -> Column:
    """A constant of the compared column's own type.

    A literal of another timestamp type would put a cast around the column and
    keep the predicate out of the scan.
    """
    return F.lit(str(value)).cast(kind)


def millis_to_timestamp(millis: Column | str) -> Column:
    """Epoch milliseconds to a timestamp with whole seconds (integer division)."""
    col = F.col(millis) if isinstance(millis, str) else millis
    return F.timestamp_seconds(F.call_function("div", col, F.lit(1000)))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed hours at one-second resolution; negative when ``end`` is earlier."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(3600)
