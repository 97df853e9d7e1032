"""Services' raw tables under one set of columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.schema import SERVICE, TRIP_DATA, Service


def harmonize(raw: DataFrame, service: Service) -> DataFrame:
    """The common columns, times under neutral names, tagged with the service."""
    source = {"pickup_datetime": service.pickup, "dropoff_datetime": service.dropoff}
    common = [c for c in TRIP_DATA.fieldNames() if c != "service_type"]
    return raw.select(
        *[F.col(source.get(c, c)).alias(c) for c in common],
        F.lit(service.name).alias("service_type"),
    )


def known_services(raw_by_service: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The frames of known services; unknown names select nothing."""
    return {name: raw for name, raw in raw_by_service.items() if name in SERVICE}


def union_services(raw_by_service: Mapping[str, DataFrame]) -> DataFrame:
    """All known services' trips in one frame, without rows if none is known."""
    frames = [harmonize(raw, SERVICE[n]) for n, raw in known_services(raw_by_service).items()]
    if not frames:
        return no_trips(raw_by_service)
    return reduce(DataFrame.unionByName, frames)


def no_trips(raw_by_service: Mapping[str, DataFrame]) -> DataFrame:
    """A frame of the common columns without rows."""
    sessions = [raw.sparkSession for raw in raw_by_service.values()]
    spark = sessions[0] if sessions else SparkSession.active()
    return spark.createDataFrame([], TRIP_DATA)
