"""Scans of stored tables that read only the partitions they need."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.times import time_literal

Moment = str | date | datetime


def time_range(
    table: DataFrame,
    time_col: str,
    low: Moment,
    high: Moment,
    day_col: str | None = None,
    *,
    half_open: bool = False,
) -> DataFrame:
    """Rows with ``low <= time <= high``, or ``< high`` when half open.

    Spark does not derive a partition predicate from a timestamp predicate. Name
    the table's day column, which must hold ``to_date(time_col)``, and the day
    bounds are added so that other days' files are not opened.
    """
    kind = table.schema[time_col].dataType
    lo, hi = time_literal(low, kind), time_literal(high, kind)
    time = F.col(time_col)
    wanted = (time >= lo) & (time < hi) if half_open else time.between(lo, hi)
    if day_col:
        wanted = wanted & F.col(day_col).between(F.to_date(lo), F.to_date(hi))
    return table.where(wanted)


def read_since(
    table: DataFrame, time_col: str, mark: Moment, day_col: str | None = None
) -> DataFrame:
    """Rows strictly later than ``mark``; rows without a time are left out."""
    lo = time_literal(mark, table.schema[time_col].dataType)
    wanted = F.col(time_col) > lo
    if day_col:
        wanted = wanted & (F.col(day_col) >= F.to_date(lo))
    return table.where(wanted)


def read_query(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """Result of an SQL text as a source; ``{name}`` in it stands for a given frame."""
    return spark.sql(sql, **views)

