"""Database tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_PASSED_ON = ("user", "password", "driver", "fetchsize")
_SPLIT = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(url: str, dbtable: str | None = None, query: str | None = None, **options) -> dict:
    """Reader options for a table or a query.

    Without the four split options Spark reads through a single connection into a
    single partition, so give all four for tables of any size. A query cannot be
    split; wrap it as ``dbtable="(select ...) t"`` instead.
    """
    if query is None and not dbtable:
        raise ValueError("reading a database needs 'dbtable' or 'query'")
    split = {k: str(options[k]) for k in _SPLIT if k in options}
    if split and len(split) < len(_SPLIT):
        raise ValueError(f"a split read needs all of {', '.join(_SPLIT)}")
    if split and query is not None:
        raise ValueError("a query cannot be split; pass it as dbtable=\"(...) t\"")
    source = {"query": query} if query is not None else {"dbtable": dbtable}
    passed = {k: str(options[k]) for k in _PASSED_ON if k in options}
    return {"url": url, **source, **passed, **split}


def read_jdbc(spark: SparkSession, url: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **options)).load()
