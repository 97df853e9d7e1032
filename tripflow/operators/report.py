"""Monthly revenue by zone and service."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.sources.tables import Moment, time_range

# Summed measures and their report names, in report order.
SUMMED = {
    "fare_amount": "revenue_monthly_fare",
    "extra": "revenue_monthly_extra",
    "mta_tax": "revenue_monthly_mta_tax",
    "tip_amount": "revenue_monthly_tip_amount",
    "tolls_amount": "revenue_monthly_tolls_amount",
    "improvement_surcharge": "revenue_monthly_improvement_surcharge",
    "total_amount": "revenue_monthly_total_amount",
    "congestion_surcharge": "revenue_monthly_congestion_surcharge",
}


def monthly_revenue(
    trips: DataFrame,
    start: Moment,
    end: Moment,
    *,
    half_open: bool = False,
    day_col: str | None = None,
) -> DataFrame:
    """Sums and means per pickup zone, month and service.

    ``start`` and ``end`` are both inclusive, or ``end`` is exclusive when half
    open. Name ``day_col`` where the table is partitioned by pickup day. Sums and
    counts combine on the map side, so a hot zone costs no more than any other.
    """
    kind = trips.schema["pickup_datetime"].dataType
    # By way of the date, which costs less per row than truncating a timestamp.
    month = F.trunc(F.to_date("pickup_datetime"), "month").cast(kind)
    wanted = time_range(trips, "pickup_datetime", start, end, day_col, half_open=half_open)
    return wanted.groupBy(
        F.col("PULocationID").alias("revenue_zone"),
        month.alias("revenue_month"),
        "service_type",
    ).agg(
        *[F.sum(measure).alias(name) for measure, name in SUMMED.items()],
        F.avg("passenger_count").alias("avg_monthly_passenger_count"),
        # An exact sum divided once; avg() of a decimal would round to its scale.
        (F.sum("trip_distance").cast("double") / F.count("trip_distance")).alias(
            "avg_monthly_trip_distance"
        ),
    )


def report_year(start: Moment) -> int:
    return start.year if isinstance(start, (date, datetime)) else int(str(start)[:4])


def report_table_name(start: Moment) -> str:
    """The table of the year reported on."""
    return f"trip_data_report_{report_year(start)}"
