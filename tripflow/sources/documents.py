"""JSON documents that hold an array of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_array_elements(
    spark: SparkSession,
    paths: str | Sequence[str],
    array_field: str,
    *,
    multi_line: bool = False,
    alias: str = "element",
) -> DataFrame:
    """One row, a variant, per element of the named array.

    Files hold one document per line, or one per file with ``multi_line``. A
    document without the array has no elements. Prefer one document per line for
    large inputs: only then does a file split into several tasks.
    """
    text = spark.read.text(paths, wholetext=multi_line)
    document = F.try_parse_json("value")
    path = f'$["{array_field}"]'
    return text.select(
        F.explode(F.try_variant_get(document, path, "array<variant>")).alias(alias)
    )
