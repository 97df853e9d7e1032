"""Readers. Each returns a lazy DataFrame."""

from tripflow.sources.documents import read_array_elements
from tripflow.sources.files import (
    list_paths,
    read_columns,
    read_csv_files,
    read_file,
    read_parquet_like,
    read_trip_files,
    stream_trip_files,
)
from tripflow.sources.footers import footer_counts, footer_marks, from_footers, with_micros
from tripflow.sources.jdbc import jdbc_options, read_jdbc
from tripflow.sources.tables import read_query, read_since, time_range
from tripflow.sources.topics import read_topic, topic_options

__all__ = [
    "footer_counts",
    "footer_marks",
    "from_footers",
    "with_micros",
    "jdbc_options",
    "list_paths",
    "read_array_elements",
    "read_columns",
    "read_csv_files",
    "read_file",
    "read_jdbc",
    "read_parquet_like",
    "read_query",
    "read_since",
    "read_topic",
    "read_trip_files",
    "stream_trip_files",
    "time_range",
    "topic_options",
]
