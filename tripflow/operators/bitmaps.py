"""Exact distinct counts that merge, by bitmaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(rows: DataFrame, number: Column, by: Sequence[Column | str]) -> DataFrame:
    """The distinct values of a whole number per group, as bitmaps by ``bucket``.

    A bitmap of 4 KB covers 32,768 numbers; a group has as many as its numbers need. Rows
    combine within tasks. Nulls count for nothing.
    """
    numbered = rows.withColumn("_number", number.cast("long")).where("_number IS NOT NULL")
    return numbered.groupBy(*by, F.bitmap_bucket_number("_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, from those of finer ones alone."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def count_bitmaps(bitmaps: DataFrame, by: Sequence[str], alias: str = "distinct_count") -> DataFrame:
    """Exact distinct counts per group of bitmaps, which are merged first."""
    counted = merged_bitmaps(bitmaps, by).groupBy(*by)
    return counted.agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(alias))
