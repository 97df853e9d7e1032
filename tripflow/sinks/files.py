"""File writers."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tripflow.session import shared_dir

_JOINING = "spark.sql.adaptive.coalescePartitions.enabled"


def write_parquet(
    df: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists"
) -> None:
    """Parquet output, in ``files`` equal files if given.

    Adaptive execution splits files further that would be larger than its advisory partition
    size, so that no task gets a share of a large result that grows with it. Leave ``files``
    out otherwise: the writing tasks then follow the plan.
    """
    spark = df.sparkSession
    if not files:
        df.write.mode(mode).parquet(path)
    elif spark.conf.get("spark.sql.adaptive.enabled") != "true":
        df.repartition(files).write.mode(mode).parquet(path)
    else:
        with small_partitions_kept(spark):
            df.hint("rebalance", files).write.mode(mode).parquet(path)


@contextmanager
def small_partitions_kept(spark: SparkSession):
    """Adaptive execution does not join small partitions of what runs inside."""
    chosen = spark.conf.get(_JOINING, None)
    spark.conf.set(_JOINING, "false")
    try:
        yield
    finally:
        if chosen is None:
            spark.conf.unset(_JOINING)
        else:
            spark.conf.set(_JOINING, chosen)


def write_json_lines(
    df: DataFrame, path: str, mode: str = "errorifexists", **options: str
) -> None:
    """One JSON object per row; null fields are written, not dropped.

    Times have milliseconds unless ``timestampFormat`` or ``timestampNTZFormat`` say more.
    """
    df.write.mode(mode).options(**{"ignoreNullFields": "false"} | options).json(path)


def stored(df: DataFrame, label: str, apart_by: Sequence[str] = ()) -> DataFrame:
    """The frame, written to the shared folder and read back: what reads it twice computes it once.

    Rows lie apart by the columns ``apart_by``, so that reading some of their values opens no others.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").partitionBy(*apart_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
