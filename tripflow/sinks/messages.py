"""Rows as JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.json_fields import json_text


def encode_messages(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One UTF-8 JSON message per row, in binary column ``value``."""
    return df.select(json_text(*(columns or df.columns)).cast("binary").alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Send every row of a batch frame to a Kafka topic as JSON."""
    (
        encode_messages(df)
        .select(F.col("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
