"""Event counts per session, on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def session_counts(
    events: DataFrame,
    event_time: str,
    keys: Sequence[str],
    bound: str,
    gap: str = "5 minutes",
    *,
    count_alias: str = "trip_count",
    low_alias: str = "start_time",
    high_alias: str = "end_time",
) -> DataFrame:
    """Count, and least and greatest ``bound``, per keys and session.

    A session goes on while the next event comes within ``gap`` of the last, the gap itself
    included; ``session_start`` is its first event and ``session_end`` its last plus the gap.
    Events without a time belong to no session. A key's events meet in one task, in order
    of time; on batch frames with hot keys use :func:`session_counts_by_span`.
    """
    counted = events.where(F.col(event_time).isNotNull()).groupBy(
        F.session_window(event_time, gap).alias("_session"), *keys).agg(
        F.count(F.lit(1)).alias(count_alias),
        F.min(bound).alias(low_alias),
        F.max(bound).alias(high_alias),
    )
    return counted.select(*keys, count_alias, low_alias, high_alias,
                          F.col("_session.start").alias("session_start"),
                          F.col("_session.end").alias("session_end"))


def session_counts_by_span(
    events: DataFrame,
    event_time: str,
    keys: Sequence[str],
    bound: str,
    gap: str = "5 minutes",
    *,
    span: str = "hour",
    **names,
) -> DataFrame:
    """The same on a batch frame, sessions being counted within spans of time first.

    A key's events spread over the tasks of its spans; only the sessions of each span, which
    an hour bounds, meet by key and are joined where one goes on after a span's end.
    """
    within = session_counts(events.withColumn("_span", F.date_trunc(span, event_time)), event_time,
                            [*keys, "_span"], bound, gap, **names)
    count, low, high = within.columns[len(keys) + 1:len(keys) + 4]
    ordered = Window.partitionBy(*keys).orderBy("session_start")
    # The gap itself still belongs to a session.
    goes_on = F.col("session_start") <= F.lag("session_end").over(ordered)
    numbered = within.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn(
        "_session", F.sum("_new").over(ordered))
    return numbered.groupBy(*keys, "_session").agg(
        F.sum(count).alias(count), F.min(low).alias(low), F.max(high).alias(high),
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
    ).drop("_session")
