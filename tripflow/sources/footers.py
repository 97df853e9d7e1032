"""Counts, least and greatest values from the footers of Parquet files, no column being read."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Fixed value: every built-in file source but Parquet.
_OTHERS = "avro,csv,json,kafka,orc,text"


def footer_frame(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files of which aggregates are pushed into the scan.

    Counts, ``min`` and ``max`` of whole numbers, doubles, booleans and days come from footers,
    grouped by partition columns or not at all, and without filters but on partitions. Times
    and text are read as ever: keep :func:`with_micros` beside a time. The frame belongs to a
    session of its own, on the same catalog, as two settings decide on this.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.sources.useV1SourceList", _OTHERS)
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session.read.parquet(path)


def from_footers(
    spark: SparkSession, path: str, ask: Callable[[DataFrame], DataFrame]
) -> list[Row]:
    """The few rows of an aggregate over files, from footers, or from columns where they lack statistics."""
    try:
        return ask(footer_frame(spark, path)).collect()
    except (PySparkException, Py4JJavaError) as e:
        # The scan refuses files whose writer left statistics out.
        if "aggregatePushdown" not in str(e):
            raise
        return ask(spark.read.parquet(path)).collect()


def with_micros(rows: DataFrame, time_col: str, alias: str | None = None) -> DataFrame:
    """Add a time's microseconds since 1970, which footers know the least and greatest of."""
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    return rows.withColumn(alias or f"{time_col}_micros", micros)


def footer_counts(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """``row_count`` of the files, in all or per values of partition columns."""
    rows = from_footers(spark, path, lambda files: files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count")))
    kinds = spark.read.parquet(path).select(*by).schema.simpleString()[len("struct<"):-1]
    return spark.createDataFrame(rows, f"{kinds + ', ' if by else ''}row_count: long")


def footer_marks(
    spark: SparkSession, path: str, services: Sequence[str], *, service_col: str = "service_type",
    micros_col: str = "pickup_datetime_micros", since: str = "1970-01-01 00:00:00",
) -> Mapping[str, str]:
    """How far each service is loaded, as text, from files partitioned by service.

    The like of ``latest_marks`` that reads no column; a service without rows has ``since``.
    """
    rows = from_footers(spark, path, lambda files: files.groupBy(service_col).agg(
        F.max(micros_col).alias("mark")))
    found = {r[service_col]: r["mark"] for r in rows if r["mark"] is not None}
    if not found:
        return {s: since for s in services}
    texts = spark.createDataFrame(list(found.items()), "service string, mark long").select(
        "service", F.timestamp_micros("mark").cast("string").alias("mark")).collect()
    marks = {r["service"]: r["mark"] for r in texts}
    return {s: marks.get(s, since) for s in services}
