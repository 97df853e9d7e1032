"""High-water marks: how far each service has been loaded."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.times import time_literal
from tripflow.schema import EPOCH


def high_water_mark(
    target: DataFrame,
    services: Sequence[str],
    service_col: str = "service_type",
    time_col: str = "pickup_datetime",
    alias: str = "latest_datetime",
) -> DataFrame:
    """Latest time per service; 1970-01-01 for a service without any.

    Every service enters the aggregation once with no time, which keeps absent
    ones in the result without a join.
    """
    spark = target.sparkSession
    kind = target.schema[time_col].dataType
    asked = spark.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in services])).alias(service_col),
        F.lit(None).cast(kind).alias(time_col),
    )
    loaded = target.where(F.col(service_col).isin(*services)).select(service_col, time_col)
    latest = F.coalesce(F.max(time_col), time_literal(EPOCH, kind))
    return loaded.unionByName(asked).groupBy(service_col).agg(latest.alias(alias))


def latest_marks(
    target: DataFrame | None,
    services: Sequence[str],
    service_col: str = "service_type",
    time_col: str = "pickup_datetime",
    day_col: str | None = None,
) -> dict[str, str]:
    """Marks as text, one row per service brought to the driver.

    As literals they reach the raw tables' scans and prune there. Without a target
    every mark is 1970-01-01; other failures are raised, since starting over would
    load everything again. If the target is partitioned by day, name ``day_col``: each
    service's last day is then found from the service column and the partition
    values, or from file footers alone if the service is a partition column too, and
    only those days' times are read.
    """
    if target is None:
        return {s: EPOCH for s in services}
    wanted = target
    if day_col:
        last_days = (
            target.where(F.col(service_col).isin(*services))
            .groupBy(service_col)
            .agg(F.max(day_col).alias("day"))
            .collect()
        )
        wanted = target.where(_any(
            (F.col(service_col) == r[service_col]) & (F.col(day_col) == F.lit(r["day"]))
            for r in last_days if r["day"] is not None
        ))
    rows = high_water_mark(wanted, services, service_col, time_col, "mark")
    return {r[service_col]: r["mark"] for r in rows.withColumn(
        "mark", F.col("mark").cast("string")).collect()}


def _any(conditions) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))
