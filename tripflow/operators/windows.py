"""Event counts per tumbling window, on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_counts(
    events: DataFrame,
    event_time: str,
    keys: Sequence[str],
    bound: str,
    width: str = "5 minutes",
    *,
    count_alias: str = "trip_count",
    low_alias: str = "start_time",
    high_alias: str = "end_time",
    with_bounds: bool = False,
) -> DataFrame:
    """Count, and least and greatest ``bound``, per window and keys.

    Events without a time belong to no window. ``with_bounds`` adds the window's
    own limits as ``window_start`` and ``window_end``.
    """
    counted = events.groupBy(F.window(event_time, width).alias("_window"), *keys).agg(
        F.count(F.lit(1)).alias(count_alias),
        F.min(bound).alias(low_alias),
        F.max(bound).alias(high_alias),
    )
    limits = [
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
    ]
    return counted.select(*keys, count_alias, low_alias, high_alias,
                          *(limits if with_bounds else []))
