"""JSON messages to typed columns, forgiving about their content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions.times import millis_to_timestamp

_WHOLE = (T.IntegerType, T.LongType)


def decode_messages(
    messages: DataFrame, schema: T.StructType, value_col: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per message with the schema's columns, after the message's own to ``keep``.

    A missing field, a value of another type, and every field of a message that is
    not JSON are null; the row stays. Fields are taken as text and then cast, so
    that ``1.0`` and ``"1"`` are read where a whole number is declared.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parts = {f"_m_{f.name}": f for f in schema.fields}
    message = F.from_json(F.col(value_col).cast("string"), as_text)
    # A condition on a generated column stays above it; below, it would parse every message again.
    parsed = messages.select(*keep, F.inline_outer(F.array(message)).alias(*parts))
    return parsed.select(*keep, *[_lenient(F.col(f"`{part}`"), f.dataType).alias(f.name)
                           for part, f in parts.items()])


def _lenient(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    value = text.try_cast(kind)
    if isinstance(kind, _WHOLE):
        number = text.try_cast("decimal(38,18)")
        return F.coalesce(value, F.when(number == F.floor(number), number.try_cast(kind)))
    return value


def with_event_time(
    decoded: DataFrame, millis_col: str, alias: str = "event_time", count_as: str | None = None
) -> DataFrame:
    """Add the event time and drop rows that have none.

    ``count_as`` names an observation holding ``rows`` and ``rows_without_time``;
    read it from the query's progress.
    """
    timed = decoded.withColumn(alias, millis_to_timestamp(millis_col))
    if count_as:
        timed = timed.observe(
            count_as,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(alias).isNull()).alias("rows_without_time"),
        )
    return timed.where(F.col(alias).isNotNull())
