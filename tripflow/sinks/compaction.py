"""Joining the small files of day partitions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.files import delete_path

TARGET_BYTES = 128 << 20


@dataclass(frozen=True)
class CompactedDay:
    """A day's files before, whose places are ``replaced``, and how many there are now."""

    day: date
    replaced: tuple[str, ...]
    files: int


def day_files(table: DataFrame, day_col: str) -> DataFrame:
    """Path and size of each file that has rows, with its day; no column is read."""
    return table.select(F.col(day_col).alias("day"), F.col("_metadata.file_path").alias("path"),
                        F.col("_metadata.file_size").alias("size")).distinct()


def due_days(table: DataFrame, day_col: str, target_bytes: int) -> DataFrame:
    """Days of several files that are smaller on average than half the target.

    ``bins`` is the number of files to make of them, each up to the target. Rows without a
    day are left where they are.
    """
    files = day_files(table, day_col).where("day IS NOT NULL")
    return files.groupBy("day").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("files"),
        F.collect_list("path").alias("paths"),
    ).where((F.col("files") > 1) & (F.col("size") * 2 < F.col("files") * target_bytes)).withColumn(
        "bins", F.ceil(F.col("size") / target_bytes).cast("int"))


def compact_days(
    spark: SparkSession,
    name: str,
    day_col: str = "pickup_date",
    cluster_by: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES,
) -> list[CompactedDay]:
    """Rewrite days of many small files as few files, and switch each day to them.

    The due days' rows are dealt by a hash to as many files as their bytes need, in one job; days
    not due are not read. The new files lie in a hidden folder of the table, and each day's
    partition is then pointed to its own: a reader sees a day before or after, never half.
    A failure leaves the days not yet switched as they were, and another run goes on. The
    files replaced stay for those who read them, see :func:`delete_replaced`. One writer per
    table at a time; the catalog must keep its partitions. What reaches the driver is a
    row per due day with the places of its files.
    """
    table = spark.table(name)
    due = due_days(table, day_col, target_bytes).orderBy("day").collect()
    if not due:
        return []
    starts, total = {}, 0
    for row in due:
        starts[row["day"]] = total
        total += row["bins"]
    numbers = F.create_map(*[x for r in due for x in (
        F.lit(r["day"]), F.struct(F.lit(starts[r["day"]]).alias("start"), F.lit(r["bins"]).alias("bins")))])
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in table.columns if c != day_col])
    rows = table.where(F.col(day_col).isin(list(starts))).withColumn("_bins", numbers[F.col(day_col)])
    place = (F.col("_bins.start") + F.pmod(row_hash, F.col("_bins.bins"))).cast("int")
    base = _location(spark, name)
    folder = f"{base}/_compacted/{uuid.uuid4().hex}"
    rows.repartitionById(total, place).drop("_bins").sortWithinPartitions(
        day_col, *cluster_by).write.partitionBy(day_col).parquet(folder)
    made = {r["day"]: r["files"] for r in day_files(spark.read.parquet(folder), day_col)
            .groupBy("day").agg(F.count(F.lit(1)).alias("files")).collect()}
    done = []
    for row in due:
        day = row["day"].isoformat()
        spark.sql(f"ALTER TABLE {name} PARTITION (`{day_col}` = '{day}') "
                  f"SET LOCATION '{folder}/{day_col}={day}'")
        done.append(CompactedDay(row["day"], tuple(row["paths"]), made[row["day"]]))
    spark.catalog.refreshTable(name)
    return done


def delete_replaced(spark: SparkSession, done: Sequence[CompactedDay]) -> None:
    """Delete the files that a compaction replaced, once nobody reads them any more."""
    for day in done:
        for path in day.replaced:
            delete_path(spark, path)


def _location(spark: SparkSession, name: str) -> str:
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return told["Location"].rstrip("/")
