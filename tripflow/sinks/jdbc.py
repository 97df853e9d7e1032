"""Database tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_rows: int = 10_000,
    connections: int | None = None,
    **properties: str,
) -> None:
    """Write a frame to a table, ``batch_rows`` per insert batch.

    Every partition opens a connection of its own; ``connections`` bounds them.
    """
    rows = df.repartition(connections) if connections else df
    rows.write.option("batchsize", batch_rows).jdbc(url, table, mode, properties)
