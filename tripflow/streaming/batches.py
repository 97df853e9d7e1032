"""Streams whose batches are written by their number, so that replaying one changes nothing.

A stream that fails between writing a batch and noting it runs that batch again, with the same
rows and number. What a batch writes lies in places named by the number and is replaced there.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.sinks.versions import FINISHED, finished_versions, write_version
from tripflow.sources.files import delete_path, list_paths
from tripflow.streaming.sinks import state_on_disk, stream_writer

SOURCE, LOAD = "load_source", "load_batch"
KINDS = ("kept", "late", "undecodable")
PART = "batch="


def ensure_batch_table(df: DataFrame, name: str, location: str | None = None) -> None:
    """A table of the frame's columns, partitioned by the source and batch that brought a row."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    stored = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} ({columns}, `{SOURCE}` string, `{LOAD}` bigint) USING parquet "
              f"PARTITIONED BY (`{SOURCE}`, `{LOAD}`){stored}")
    if location and list_paths(spark, location):
        # Batches of an earlier process.
        spark.catalog.recoverPartitions(name)


def start_table(
    df: DataFrame, name: str, checkpoint: str, *, source: str = "stream",
    location: str | None = None, every: str | None = None,
) -> StreamingQuery:
    """Append a stream's rows to a table exactly once, whenever and in whatever order they come.

    Each batch is a partition of the table, under the stream's ``source``, by which several
    streams fill one table. A row is taken when it arrives, as the checkpoint knows, and not
    by its own time: late rows need no second look. Without ``every`` the query takes what
    has arrived and stops. Table, source and checkpoint belong together.
    """
    ensure_batch_table(df, name, location)
    columns = ", ".join(f"`{c}`" for c in df.columns)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION (`{SOURCE}` = '{source}', `{LOAD}` = {batch_id}) "
            f"SELECT {columns} FROM {{rows}}", rows=batch)
        # Batches run in a session of their own, whose news of files stays there.
        df.sparkSession.catalog.refreshTable(name)

    with state_on_disk(df.sparkSession):
        return stream_writer(df, "append", checkpoint, every).foreachBatch(write).start()


def batch_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows of finished batches under ``path`` with their number, None before the first."""
    found = [p.rsplit("/", 1)[0] for p in list_paths(spark, f"{path}/{PART}*/{FINISHED}")]
    if not found:
        return None
    return spark.read.option("basePath", path).parquet(*found).withColumnRenamed("batch", LOAD)


def start_sorted(
    stream: DataFrame, path: str, checkpoint: str, *, event_time: str = "event_time",
    decodable: Column | None = None, delay: timedelta = timedelta(seconds=5),
    width: timedelta = timedelta(minutes=5),
    every: str | None = None,
) -> StreamingQuery:
    """Write every row of a stream to one of ``kept``, ``late`` and ``undecodable`` under ``path``.

    Undecodable rows have no event time, or are not ``decodable``. Late rows fall into windows of
    ``width`` that end at or before the watermark, which windowed counts would drop unseen: the
    latest event time of earlier batches, undecodable rows aside, less ``delay``. All others are
    kept. No row is lost, and each batch's rows and watermark are written by its number; one
    row with the watermark is what a batch hands to the next.
    """
    micro = timedelta(microseconds=1)
    good = F.col(event_time).isNotNull()
    if decodable is not None:
        good = good & F.coalesce(decodable, F.lit(False))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = batch_rows(spark, f"{path}/latest")
        before = None if seen is None else seen.where(F.col(LOAD) < batch_id).agg(F.max("latest")).first()[0]
        # A window column would drop rows without a time.
        time = F.unix_micros(F.col(event_time).cast("timestamp"))
        late = F.lit(False)
        if before is not None:
            late = time - F.pmod(time, F.lit(width // micro)) + width // micro <= before - delay // micro
        kind = F.when(~good, "undecodable").when(late, "late").otherwise("kept")
        batch = batch.persist()
        try:
            for name in KINDS:
                batch.where(kind == name).write.mode("overwrite").parquet(f"{path}/{name}/{PART}{batch_id}")
            latest = batch.where(good).agg(F.max(time).alias("latest"))
            latest.write.mode("overwrite").parquet(f"{path}/latest/{PART}{batch_id}")
        finally:
            batch.unpersist()

    return stream_writer(stream, "append", checkpoint, every).foreachBatch(write).start()


def read_sorted(spark: SparkSession, path: str) -> DataFrame:
    """All rows that :func:`start_sorted` wrote, with their ``kind``."""
    frames = [batch_rows(spark, f"{path}/{name}").withColumn("kind", F.lit(name)) for name in KINDS]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).drop(LOAD)


def start_update(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write the groups that each batch changed, with their new values, under the batch's number.

    The result so far is read by :func:`read_updated`. Unlike with complete output a batch costs what
    it changes, and state is dropped behind the watermark.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/updates/{PART}{batch_id}")

    with state_on_disk(df.sparkSession):
        return stream_writer(df, "update", checkpoint, every).foreachBatch(write).start()


def read_updated(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last values of each group, by ``keys``: the folded ones and updates since.

    Only finished batches count, so that readers never see half of one.
    """
    folded = finished_versions(spark, f"{path}/folded")
    base = spark.read.parquet(folded[-1]) if folded else None
    updates = batch_rows(spark, f"{path}/updates")
    if base is not None and updates is not None:
        # Updates that a fold took in, and may still be there, win against nothing.
        updates = base.unionByName(updates)
    rows = updates if updates is not None else base
    values = [c for c in rows.columns if c not in (*keys, LOAD)]
    last = F.max_by(F.struct(*values), LOAD).alias("_last")
    return rows.groupBy(*keys).agg(last, F.max(LOAD).alias(LOAD)).select(*keys, "_last.*", LOAD)


def fold_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> int:
    """Store the result so far as one version and delete the updates it holds; how many.

    Run between batches, or the reader of a deleted update has to read again. A fold that fails
    leaves the updates, and one that fails after storing leaves updates that change nothing.
    """
    done = [p.rsplit("/", 1)[0] for p in list_paths(spark, f"{path}/updates/{PART}*/{FINISHED}")]
    if done:
        write_version(read_updated(spark, path, keys), f"{path}/folded")
        for folder in done:
            delete_path(spark, folder)
    return len(done)
