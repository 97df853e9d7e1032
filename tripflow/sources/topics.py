"""Kafka topics. The connector jar is supplied at submit time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(servers: str, topic: str, group_id: str | None = None, **options) -> dict:
    """Reader options: from the earliest offset unless told otherwise."""
    found = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if group_id:
        found["kafka.group.id"] = group_id
    return {**found, **{k: str(v) for k, v in options.items()}}


def read_topic(
    spark: SparkSession, servers: str, topic: str, group_id: str | None = None, **options
) -> DataFrame:
    """Streaming frame of the topic's messages, in column ``value``."""
    settings = topic_options(servers, topic, group_id, **options)
    return spark.readStream.format("kafka").options(**settings).load()
