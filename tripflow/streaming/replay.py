"""Bounded files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def replay_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    *,
    single_file: bool = False,
    **options,
) -> DataFrame:
    """Stream the files under ``path``, a folder or glob.

    With ``single_file`` the path may also name one file; partition columns of a
    folder are then not read from its subfolders' names.

    By default everything present is one batch, so no row can be late whatever the
    order of the files. ``files_per_trigger`` paces the replay; files then go by
    modification time and a watermark may drop rows of files out of order.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(_as_glob(path) if single_file else path)


def _as_glob(path: str) -> str:
    # The file stream takes a plain path for a folder; a glob may match a file.
    if any(c in path for c in "*?[{"):
        return path
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"
