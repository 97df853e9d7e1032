"""File readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tripflow.schema import Service
from tripflow.sources.jdbc import read_jdbc


# The suffixes users' paths end in.
FORMAT_OF_SUFFIX = {".csv": "csv", ".csv.gz": "csv", ".parquet": "parquet", ".json": "json"}


def read_file(spark: SparkSession, path: str, **options) -> DataFrame:
    """Pick the reader by the path's prefix or suffix.

    ``jdbc:`` URLs need ``dbtable`` or ``query``; paths of other suffixes than those
    above raise ``ValueError``. The options go to the reader, ``schema`` included.
    """
    if path.startswith("jdbc:"):
        return read_jdbc(spark, path, **options)
    found = [f for suffix, f in FORMAT_OF_SUFFIX.items() if path.rstrip("/").endswith(suffix)]
    if not found:
        raise ValueError(f"unsupported file format or connection string: {path}")
    return spark.read.load(path, format=found[0], **options)


def read_csv_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """CSV files with a header, every column text, plus the source ``filename``."""
    files = spark.read.csv(paths, header=True)
    return files.select("*", F.col("_metadata.file_name").alias("filename"))


def read_trip_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    service: Service,
    partitions: int | None = None,
) -> DataFrame:
    """A service's CSV files, gzipped or not, under its declared schema.

    The header row is skipped and columns bind by position. Where the service
    ignores extra trailing values such rows are kept without them; elsewhere a row that
    does not fit the schema fails the read. A value that is not of its column's type
    fails the read in either case. Gzip files do not split, so one file is one
    task: pass ``partitions`` when there are fewer files than cores.
    """
    files = _trip_columns(spark.read, paths, service)
    return files.repartition(partitions) if partitions else files


def stream_trip_files(spark: SparkSession, path: str, service: Service) -> DataFrame:
    """A service's CSV files as a stream: each file that arrives under a folder or glob, once.

    Files are read as by :func:`read_trip_files`, whatever their age.
    """
    # By default a file much older than the newest would be passed over.
    reader = spark.readStream.option("maxFileAge", "36500d")
    return _trip_columns(reader, path, service)


def _trip_columns(reader: DataFrameReader | DataStreamReader, paths, service: Service) -> DataFrame:
    if service.ignore_extra_values:
        # Permissive parsing would turn bad values into nulls along with ignoring extras.
        as_text = T.StructType([T.StructField(f.name, T.StringType())
                                for f in service.file_schema.fields])
        text = reader.schema(as_text).csv(paths, header=True, mode="PERMISSIVE")
        return text.select(*[_strict(f).alias(f.name) for f in service.file_schema.fields])
    return reader.schema(service.file_schema).csv(paths, header=True, mode="FAILFAST")


def _strict(field: T.StructField) -> Column:
    """The text column as the field's type; a value that is not of it raises."""
    text = F.col(field.name)
    problem = F.concat(F.lit(f"bad value in {field.name}: "), text)
    # The value is named once, so that each text is cast once.
    return F.coalesce(text.try_cast(field.dataType),
                      F.when(text.isNotNull(), F.raise_error(problem).cast(field.dataType)))


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that a glob names, sorted, by the session's file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return sorted(s.getPath().toString() for s in system.globStatus(path) or [])


def delete_path(spark: SparkSession, name: str) -> None:
    """Delete a file or folder by the session's file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def read_parquet_like(
    spark: SparkSession, paths: Sequence[str], reference: str | None = None
) -> DataFrame:
    """Several Parquet files under the schema of one of them, by default the first."""
    schema: T.StructType = spark.read.parquet(reference or paths[0]).schema
    return spark.read.schema(schema).parquet(*paths)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str], **options) -> DataFrame:
    """Named columns of a CSV file; the others are not parsed."""
    return spark.read.csv(path, header=True, **options).select(*columns)
