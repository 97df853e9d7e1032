"""Tables whose content is replaced as a whole, by a new folder and one switch.

Each version of a table lies in a folder of its own under the table's base folder. It counts
once its write has finished, and then the catalog's entry is pointed to it. A write that
fails changes nothing, readers of the earlier version keep their files, and a table may be
replaced by rows computed from itself.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripflow.sources.files import delete_path, list_paths

FINISHED = "_SUCCESS"


def finished_versions(spark: SparkSession, base: str) -> list[str]:
    """Folders of finished versions, oldest first."""
    return [posixpath.dirname(p) for p in list_paths(spark, f"{base}/v[0-9]*-*/{FINISHED}")]


def write_version(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> str:
    """Write the frame as the newest version under ``base``; returns its folder.

    One writer per table at a time. The folder's number is above all others there, those of
    failed writes included.
    """
    spark = df.sparkSession
    begun = [posixpath.basename(p) for p in list_paths(spark, f"{base}/v[0-9]*-*")]
    number = max((int(name[1:].split("-")[0]) for name in begun), default=0) + 1
    path = f"{base}/v{number:012d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return path


def point_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """Make a finished version the content of a table.

    If the table has the same columns and partitioning this is one change of its location.
    Otherwise its entry is made anew, for which it is absent for a moment; its versions are not.
    """
    table = name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"
    data = [f for f in schema.fields if f.name not in partition_by]
    columns = [(f.name, f.dataType.simpleString(), False) for f in data]
    columns += [(c, schema[c].dataType.simpleString(), True) for c in partition_by]
    if spark.catalog.tableExists(table):
        found = [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(table)]
        if found == columns and _switchable(spark, table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    ddl = ", ".join(f"`{c}` {kind}" for c, kind, _ in columns)
    by = ", ".join(f"`{c}`" for c in partition_by)
    partitioned = f" PARTITIONED BY ({by})" if by else ""
    _publisher(spark).sql(f"CREATE TABLE {table} ({ddl}) USING parquet{partitioned} LOCATION '{path}'")


def register_version(spark: SparkSession, name: str, base: str) -> bool:
    """Make the newest finished version of an earlier process a table; whether there is one."""
    found = finished_versions(spark, base)
    if found:
        table = name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"
        _publisher(spark).catalog.createTable(table, path=found[-1], source="parquet")
    return bool(found)


def expire_versions(spark: SparkSession, base: str, keep: int = 1) -> list[str]:
    """Delete all but the newest version and ``keep`` before it, and failed writes before it.

    Returns the folders. Whoever still reads a version needs it kept.
    """
    finished = finished_versions(spark, base)
    if not finished:
        return []
    stay = set(finished[-1 - keep:])
    gone = [p for p in list_paths(spark, f"{base}/v[0-9]*-*") if p < finished[-1] and p not in stay]
    for path in gone:
        delete_path(spark, path)
    return gone


def _switchable(spark: SparkSession, table: str) -> bool:
    """Whether a change of location moves the whole table: its own folder, listed for partitions."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    return told.get("Type") == "EXTERNAL" and told.get("Partition Provider") != "Catalog"


def _publisher(spark: SparkSession) -> SparkSession:
    """A session on the same catalog whose new tables find their partitions by their folders.

    Partitions kept in the catalog have locations of their own, which no single change moves.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    return session
