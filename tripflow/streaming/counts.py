"""Windowed counts over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tripflow.operators.windows import tumbling_counts


def with_watermark(stream: DataFrame, event_time: str = "event_time",
                   delay: str = "5 seconds") -> DataFrame:
    """Accept events up to ``delay`` behind the latest seen.

    Spark tracks event time only on zoned timestamps, so others are cast.
    """
    zoned = stream.withColumn(event_time, stream[event_time].cast("timestamp"))
    return zoned.withWatermark(event_time, delay)


def stream_zone_pair_counts(
    stream: DataFrame,
    watermark: str = "5 seconds",
    width: str = "5 minutes",
    *,
    event_time: str = "event_time",
    keys: Sequence[str] = ("PULocationID", "DOLocationID"),
    bound: str = "lpep_dropoff_datetime",
    **names,
) -> DataFrame:
    """Trips per window and zone pair, with the first and last time among them.

    In append mode a window comes out once the watermark has passed its end, and
    later rows for it are dropped. Rows combine before they reach the state, so a
    busy pair adds one state update per task.
    """
    timed = with_watermark(stream, event_time, watermark)
    return tumbling_counts(timed, event_time, keys, bound, width, **names)
