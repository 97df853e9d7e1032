"""Starting streaming queries.

Each takes a checkpoint folder that all executors share; a restarted query
continues from it.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripflow.sources.files import list_paths

BATCH = "batch-"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROW_COUNT = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
_ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession):
    """RocksDB state for a query started inside, unless the session chose a store.

    The default store keeps all of a partition's groups on the executor's heap. Unless the
    session says so, RocksDB does not keep count of its rows, for which it would look up each
    group before it writes or removes it; progress then reports no total of state rows.
    """
    ours = {}
    if spark.conf.get(_PROVIDER, _ON_HEAP) == _ON_HEAP:
        ours[_PROVIDER] = _ROCKSDB
    if spark.conf.get(_ROW_COUNT, None) is None:
        ours[_ROW_COUNT] = "false"
    chosen = {key: spark.conf.get(key, None) for key in ours}
    for key, value in ours.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in chosen.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stream_writer(df: DataFrame, mode: str, checkpoint: str, every: str | None):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_append(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, fmt: str = "parquet"
) -> StreamingQuery:
    """Append finished rows to files under ``path``, each exactly once.

    Without ``every`` the query takes what is available and stops.
    """
    with state_on_disk(df.sparkSession):
        return stream_writer(df, "append", checkpoint, every).format(fmt).start(path)


def start_complete(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write the whole current result, open windows included, after each batch.

    Each batch fills a folder of its own under ``path``, so that a reader by
    :func:`read_complete` never sees half of one, and a failed one leaves the last in
    place. Every window ever seen is kept as state and written each time: for tests and
    streams with few groups.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}{batch_id}")

    with state_on_disk(df.sparkSession):
        return stream_writer(df, "complete", checkpoint, every).foreachBatch(write).start()


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The last result that :func:`start_complete` finished."""
    done = [p.rsplit("/", 1)[0] for p in list_paths(spark, f"{path}/{BATCH}*/_SUCCESS")]
    return spark.read.parquet(max(done, key=lambda p: int(p.rsplit(BATCH, 1)[1])))


def start_console(
    df: DataFrame, checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Print rows; for looking at a stream, not for keeping it."""
    with state_on_disk(df.sparkSession):
        return stream_writer(df, mode, checkpoint, every).format("console").option(
            "truncate", "false").start()
