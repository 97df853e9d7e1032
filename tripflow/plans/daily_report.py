"""The revenue report from stored sums per day, of which only changed days are computed anew."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.report import SUMMED
from tripflow.sources.files import delete_path
from tripflow.sources.tables import Moment

KEYS = ("service_type", "revenue_zone")
_MEANS = ("passenger_count", "trip_distance")


def daily_sums(trips: DataFrame, day_col: str = "pickup_date") -> DataFrame:
    """Sums and counts per day, pickup zone and service, which add up to any range of days."""
    return trips.groupBy(
        "service_type", F.col("PULocationID").alias("revenue_zone"), F.col(day_col).alias("report_day")
    ).agg(
        *[F.sum(c).alias(c) for c in (*SUMMED, *_MEANS)],
        *[F.count(c).alias(f"{c}_rows") for c in _MEANS],
    )


def refresh_daily_sums(
    trips: DataFrame, path: str, days: Sequence[date] | None = None, day_col: str = "pickup_date"
) -> None:
    """Compute the sums of ``days`` anew, or of all days at first, from a table by day.

    Other days' files are neither read nor touched: each day is a folder under ``path``, replaced
    as a whole. A day without rows any more, and not among new sums, is deleted. The list of
    days is what the driver handles.
    """
    spark = trips.sparkSession
    wanted = trips if days is None else trips.where(F.col(day_col).isin(list(days)))
    sums = daily_sums(wanted, day_col).where("report_day IS NOT NULL")
    # One day's sums are one file.
    rows = sums.repartition("report_day").sortWithinPartitions("report_day", *KEYS)
    rows.write.mode("overwrite").option(
        "partitionOverwriteMode", "static" if days is None else "dynamic").partitionBy("report_day").parquet(path)
    if days is not None:
        _drop_empty_days(spark, trips, path, days, day_col)


def _drop_empty_days(spark: SparkSession, trips: DataFrame, path: str, days: Sequence[date], day_col: str) -> None:
    left = {r[0] for r in trips.where(F.col(day_col).isin(list(days))).select(day_col).distinct().collect()}
    for day in days:
        if day not in left:
            delete_path(spark, f"{path}/report_day={day.isoformat()}")


def report_from_sums(
    sums: DataFrame, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """The monthly report over whole days, ``end`` excluded, from stored sums alone."""
    day = F.col("report_day")
    if start is not None:
        sums = sums.where(day >= F.lit(str(start)).cast("date"))
    if end is not None:
        sums = sums.where(day < F.lit(str(end)).cast("date"))
    month = F.trunc("report_day", "month").cast("timestamp_ntz")
    return sums.groupBy("revenue_zone", month.alias("revenue_month"), "service_type").agg(
        *[F.sum(c).alias(name) for c, name in SUMMED.items()],
        (F.sum("passenger_count") / F.sum("passenger_count_rows")).alias("avg_monthly_passenger_count"),
        (F.sum("trip_distance").cast("double") / F.sum("trip_distance_rows")).alias("avg_monthly_trip_distance"),
    )
