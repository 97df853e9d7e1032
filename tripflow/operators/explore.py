"""Counts, distincts and extremes over a fact table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.times import hours_between


def count_rows(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def count_where(df: DataFrame, condition: Column, alias: str = "row_count") -> DataFrame:
    return count_rows(df.where(condition), alias)


def count_distinct(df: DataFrame, column: str, alias: str = "distinct_count") -> DataFrame:
    """Exact distinct count; values are made unique on the map side first."""
    return df.agg(F.countDistinct(column).alias(alias))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def on_day(day: str | date, *time_cols: str) -> Column:
    """Every named time falls on ``day``.

    Written as a range, which unlike a comparison of ``to_date`` reaches the scan.
    """
    begin = F.lit(str(day)).cast("date")
    end = F.date_add(begin, 1)
    return _all((F.col(c) >= begin) & (F.col(c) < end) for c in time_cols)


def same_day(first: str, *others: str) -> Column:
    """All named times fall on one day, whichever it is."""
    return _all(F.to_date(first) == F.to_date(c) for c in others)


def _all(conditions) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def longest_hours(df: DataFrame, start: str, end: str, alias: str = "longest_hours") -> DataFrame:
    return df.agg(F.max(hours_between(start, end)).alias(alias))


def mean_by_group(
    df: DataFrame, group: str, value: str, digits: int = 2, alias: str = "avg_value"
) -> DataFrame:
    """Rounded mean per group, largest first; equal means are ordered by group."""
    means = df.groupBy(group).agg(F.round(F.avg(value), digits).alias(alias))
    return means.orderBy(F.desc(alias), group)


def time_at(df: DataFrame, time_col: str, position: int) -> datetime | None:
    """The time at a position, from 0, of all rows in order of time, those without one first.

    Rows are counted per day, then per minute, second and microsecond of what holds the position.
    These counts reach the driver and are bounded by calendar and clock, not by the rows.
    """
    rows = df.select(F.col(time_col).alias("time"), F.unix_micros(F.col(time_col).cast("timestamp")).alias("micros"))
    part, before = F.lit(True), 0
    for micros in (86_400_000_000, 60_000_000, 1_000_000, 1):
        place = F.col("micros") - F.pmod("micros", F.lit(micros))
        counts = rows.where(part).groupBy(place.alias("place")).agg(
            F.count(F.lit(1)).alias("n"), F.min("time").alias("time")).collect()
        for found in sorted(counts, key=lambda r: (r["place"] is not None, r["place"])):
            if before + found["n"] > position >= before:
                break
            before += found["n"]
        else:
            raise ValueError(f"no row at position {position}")
        if found["place"] is None:
            return None
        part = place == found["place"]
    return found["time"]
