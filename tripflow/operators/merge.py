"""Insert-only merge: add the rows whose id the target does not hold yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.keys import md5_key
from tripflow.sinks.files import stored

ROW_ID = "unique_row_id"


def with_row_id(
    raw: DataFrame,
    key_cols: Sequence[Column | str],
    source_name: str | Column,
    *,
    make_key=md5_key,
    sep: str = "",
) -> DataFrame:
    """Staging rows: row id and source file in front of the raw columns.

    ``source_name`` may be a column, such as ``input_file_name()``.
    """
    return raw.select(
        make_key(key_cols, sep).alias(ROW_ID), F.lit(source_name).alias("filename"), "*"
    )


def insert_only(staging: DataFrame, target: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Staging rows whose ``key`` is absent from the target.

    Rows the target holds are left out whatever their other columns say. Rows that
    share a key absent from the target are all kept.

    One anti join straight over both shuffles, so that adaptive execution can split a
    hot key, broadcast a side it finds small, and drop the join if a side is empty.
    """
    return staging.join(target.select(key), key, "left_anti")


def new_ids(staging: DataFrame, target: DataFrame, key: str = ROW_ID) -> DataFrame:
    """Staging ids that a target in buckets by ``key`` lacks; the target stays where it lies.

    The ids are made distinct, which combines a hot one before it is moved, and go to the
    target's buckets.
    """
    return staging.select(key).distinct().join(target.select(key), key, "left_anti")


def insert_only_bucketed(staging: DataFrame, target: DataFrame, key: str = ROW_ID) -> DataFrame:
    """:func:`insert_only` for a target in buckets by ``key``.

    The new ids are stored, so that adaptive execution can split a hot one when they choose
    the staging rows. The staging is read twice and should be stored too.
    """
    return insert_only_stored(staging, target, key)


def insert_only_stored(
    staging: DataFrame, target: DataFrame, key: str = ROW_ID, *,
    day: Column | None = None, target_day: Column | None = None,
) -> DataFrame:
    """:func:`insert_only` for a stored staging and a stored target: ids are moved, not rows.

    Where ids of different days differ, give the staging's ``day`` and the target's: rows of
    days that the target lacks are then new without a comparison, and of the target only days
    of the others are read. Staging rows are moved only if many of the compared ones are new.
    """
    fresh = None
    if day is not None:
        days = days_of(staging, day)
        held = days_of(on_days(target, target_day, days), target_day)
        fresh = on_days(staging, day, [d for d in days if d not in held])
        staging, target = on_days(staging, day, held), on_days(target, target_day, held)
        if not held:
            return fresh
    new = stored(new_ids(staging, target, key), "new-ids").withColumnRenamed(key, "_new")
    found = staging.join(new, staging[key].eqNullSafe(new["_new"]), "left_semi")
    return found if fresh is None else fresh.unionByName(found)


def days_of(rows: DataFrame, day: Column) -> list:
    """The days rows fall on, None among them for rows without one.

    One row per day reaches the driver, so the calendar bounds it.
    """
    return [r["day"] for r in rows.select(day.alias("day")).distinct().collect()]


def on_days(table: DataFrame, day: Column, days: Sequence) -> DataFrame:
    """Rows of the listed days; None stands for rows without a day."""
    wanted = day.isin([d for d in days if d is not None])
    return table.where(wanted | day.isNull() if None in days else wanted)
