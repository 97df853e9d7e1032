"""Creating, replacing and filling stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.sinks.versions import (
    expire_versions,
    point_table,
    register_version,
    write_version,
)
from tripflow.sources.files import list_paths


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    *,
    day_of: str | None = None,
    day_col: str = "pickup_date",
    location: str | None = None,
    bucket_by: tuple[str, int] | None = None,
) -> None:
    """Create a Parquet table unless it exists.

    ``day_of`` names a time column; the table then gets a derived ``day_col`` and
    is partitioned by it. A ``location`` may hold the table's files already. ``bucket_by``
    names a column and a number: rows lie in so many buckets by its hash, sorted by it, and a
    join by it does not move them. An existing table must have the same columns, types,
    partitioning and bucket column.
    """
    if day_of and bucket_by:
        raise ValueError("a table is laid out by day or by buckets")
    fields = list(schema.fields)
    if day_of:
        fields.append(T.StructField(day_col, T.DateType(), True, {"comment": f"Day of {day_of}."}))
    if location and not bucket_by:
        register_stored(spark, name, location)
    if spark.catalog.tableExists(name):
        wanted = {f.name: (f.dataType.simpleString(), bool(day_of) and f.name == day_col,
                           bool(bucket_by) and f.name == bucket_by[0]) for f in fields}
        found = {c.name: (c.dataType, c.isPartition, c.isBucket)
                 for c in spark.catalog.listColumns(name)}
        if wanted != found:
            differing = sorted(set(wanted.items()) ^ set(found.items()))
            raise ValueError(f"table {name} has another layout: {differing}")
        return
    columns = ", ".join(_column_ddl(f) for f in fields)
    partitioned = f" PARTITIONED BY (`{day_col}`)" if day_of else ""
    bucketed = (f" CLUSTERED BY (`{bucket_by[0]}`) SORTED BY (`{bucket_by[0]}`) "
                f"INTO {bucket_by[1]} BUCKETS" if bucket_by else "")
    stored = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) "
              f"USING parquet{partitioned}{bucketed}{stored}")


def register_stored(spark: SparkSession, name: str, location: str) -> bool:
    """Make files of an earlier process a table again, partitions included.

    Returns whether the catalog knows the table afterwards.
    """
    if not spark.catalog.tableExists(name) and register_version(spark, name, location):
        return True
    if not spark.catalog.tableExists(name) and list_paths(spark, f"{location}/_SUCCESS"):
        stored = spark.read.parquet(location)
        if stored.columns:
            spark.catalog.createTable(name, path=location, source="parquet")
            if any(c.isPartition for c in spark.catalog.listColumns(name)):
                spark.catalog.recoverPartitions(name)
    return spark.catalog.tableExists(name)


def _column_ddl(field: T.StructField) -> str:
    comment = (field.metadata or {}).get("comment")
    note = " COMMENT '{}'".format(comment.replace("'", "\\'")) if comment else ""
    return f"`{field.name}` {field.dataType.simpleString()}{note}"


def replace_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), location: str | None = None,
    keep: int = 1
) -> None:
    """Create or replace a table with the frame's rows and schema, atomically.

    The rows, which may come from the table itself, are written to a new folder under
    ``location``, by default one in the warehouse; then the table is pointed to it, see
    :mod:`tripflow.sinks.versions`. If the write fails the table keeps its rows. ``keep``
    earlier versions stay for their readers.
    """
    spark = df.sparkSession
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    base = (location or f"{warehouse}/{name}.versions").rstrip("/")
    path = write_version(df, base, partition_by)
    point_table(spark, name, path, df.schema, partition_by)
    expire_versions(spark, base, keep)


def append_table(
    df: DataFrame,
    name: str,
    *,
    day_of: str | None = None,
    day_col: str = "pickup_date",
    cluster_by: Sequence[str] = (),
    partitions: int | None = None,
    bucket_by: tuple[str, int] | None = None,
) -> None:
    """Append by column name.

    With ``day_of`` the table's day column is filled from that time, the rows of a
    file are ordered by ``cluster_by``, and ``partitions`` are made as in
    :func:`spread_by_day`. Rows of a table with buckets are dealt out by them, so that a
    task writes few files; adaptive execution spreads a large bucket over several tasks.
    """
    rows = df
    if bucket_by:
        key, buckets = bucket_by
        rows = df.hint("rebalance", buckets, key)
    if day_of:
        rows = spread_by_day(df, day_of, day_col, partitions)
        rows = rows.sortWithinPartitions(day_col, *cluster_by)
    rows.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=False)


def truncate_table(spark: SparkSession, name: str) -> None:
    """Empty a table that Spark manages; it refuses this for tables with a location."""
    spark.sql(f"TRUNCATE TABLE {name}")


def spread_by_day(
    df: DataFrame, time_col: str, day_col: str, partitions: int | None = None
) -> DataFrame:
    """Add the day column and deal rows out by it, for writing.

    A task holds one day or a few, so there are about as many files as tasks and days
    together; adaptive execution joins small tasks and spreads a large day over several. The
    input is read once. ``partitions`` fixes the number of tasks, which are then ranges of
    the day and a hash of the row; so it is without adaptive execution. Ranges need a sample,
    for which the input is computed once more.
    """
    spark = df.sparkSession
    dated = df.withColumn(day_col, F.to_date(time_col))
    if not partitions and spark.conf.get("spark.sql.adaptive.enabled") == "true":
        return dated.hint("rebalance", day_col)
    order = [F.col(day_col), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    if partitions:
        return dated.repartitionByRange(partitions, *order)
    return dated.repartitionByRange(*order)


def write_day_partitioned(
    df: DataFrame,
    path: str,
    time_col: str,
    day_col: str,
    cluster_by: Sequence[str] = (),
    mode: str = "errorifexists",
    partitions: int | None = None,
) -> None:
    """Parquet partitioned by day, rows of a file ordered by ``cluster_by``.

    The ordering narrows the row groups' value ranges, so filters on those columns
    skip row groups.
    """
    rows = spread_by_day(df, time_col, day_col, partitions)
    rows = rows.sortWithinPartitions(day_col, *cluster_by)
    rows.write.mode(mode).partitionBy(day_col).parquet(path)
