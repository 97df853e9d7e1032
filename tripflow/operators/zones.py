"""Trips against the zone lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zone_key(column: str) -> Column:
    """Zone ids compare as numbers: lookup files hold text, so ``'01'`` equals 1."""
    return F.col(column).try_cast("bigint")


def with_zone(
    trips: DataFrame,
    zones: DataFrame,
    trip_key: str = "PULocationID",
    zone_id: str = "LocationID",
    zone_name: str = "Zone",
) -> DataFrame:
    """Trips with the name of their zone; trips of unknown zones are left out.

    No broadcast hint: Spark broadcasts the lookup while its size is under the
    session's threshold, and adaptive execution splits a hot zone beyond it.
    """
    lookup = zones.select(zone_key(zone_id).alias("_zone_key"), F.col(zone_name))
    joined = trips.withColumn("_trip_key", zone_key(trip_key)).join(
        lookup, F.col("_trip_key") == F.col("_zone_key")
    )
    return joined.drop("_trip_key", "_zone_key")


def zone_counts(
    trips: DataFrame,
    zones: DataFrame,
    trip_key: str = "PULocationID",
    zone_id: str = "LocationID",
    zone_name: str = "Zone",
    alias: str = "trip_count",
) -> DataFrame:
    """Trips per zone name.

    Trips are counted per key before the join, so the join sees one row per key
    however many trips a zone has. A key listed twice in the lookup still counts
    twice, as in a join of the single trips.
    """
    per_key = trips.groupBy(zone_key(trip_key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_trips")
    )
    lookup = zones.select(zone_key(zone_id).alias("_key"), F.col(zone_name))
    return (
        per_key.join(lookup, "_key").groupBy(zone_name).agg(F.sum("_trips").alias(alias))
    )


def least_frequent_zones(
    trips: DataFrame, zones: DataFrame, k: int = 1, zone_name: str = "Zone", **names: str
) -> DataFrame:
    """The ``k`` zones with the fewest trips; equal counts are ordered by name."""
    counts = zone_counts(trips, zones, zone_name=zone_name, alias="trip_count", **names)
    return counts.orderBy(F.asc("trip_count"), F.asc(zone_name)).limit(k)
