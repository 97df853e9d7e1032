"""The provided order tables seen as trips.

A trip is a line item with its order: picked up on the order date, dropped off on
the ship date, at the supplier's zone, for the customer's zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.schema import MONEY, SERVICE, TRIP_DATA, TRIP_MESSAGE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders, as far as trips are made of them.

    To be stored by what makes trips several times: the join is then made once, and these columns
    are narrower than a trip's.
    """
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate", "o_orderdate", "o_custkey", "o_totalprice")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harmonised trips of both services."""
    return as_trips(lines(spark, sf_dir))


def as_trips(joined: DataFrame) -> DataFrame:
    """Harmonised trips of the rows that :func:`lines` gives."""
    columns = trip_columns()
    return joined.select(*[columns[c].alias(c) for c in TRIP_DATA.fieldNames()])


def trip_columns() -> dict[str, Column]:
    """What each column of a trip is, in those that :func:`lines` gives."""
    def money(value: Column) -> Column:
        return value.cast(MONEY)

    return {
        "VendorID": (F.col("l_partkey") % 2 + 1).cast("string"),
        "pickup_datetime": F.col("o_orderdate"),
        "dropoff_datetime": F.col("l_shipdate"),
        "store_and_fwd_flag": F.when(F.col("l_returnflag") == "R", "Y").otherwise("N"),
        "RatecodeID": F.col("l_linenumber").cast("string"),
        "PULocationID": F.col("l_suppkey").cast("string"),
        "DOLocationID": F.col("o_custkey").cast("string"),
        "passenger_count": F.col("l_quantity").cast("int"),
        "trip_distance": money(F.col("l_quantity")),
        "fare_amount": money(F.col("l_extendedprice")),
        "extra": money(F.col("l_discount")),
        "mta_tax": money(F.col("l_tax")),
        "tip_amount": money(F.col("l_discount") + F.col("l_tax")),
        "tolls_amount": money(F.col("l_partkey") % 7),
        "improvement_surcharge": money(F.lit(0.3)),
        "total_amount": money(F.col("o_totalprice")),
        "payment_type": F.col("l_linenumber") % 6 + 1,
        "congestion_surcharge": F.when(F.col("l_suppkey") % 3 == 0, money(F.lit(2.5))),
        "service_type": F.when(F.col("l_linestatus") == "O", "yellow").otherwise("green"),
    }


def raw_trips(spark: SparkSession, sf_dir: str, service_name: str) -> DataFrame:
    """One service's trips in the shape of its raw table."""
    return as_raw(trips(spark, sf_dir), service_name)


def as_raw(harmonized: DataFrame, service_name: str) -> DataFrame:
    service = SERVICE[service_name]
    times = {service.pickup: "pickup_datetime", service.dropoff: "dropoff_datetime"}
    rows = harmonized.where(F.col("service_type") == service_name)
    return rows.select(*[
        (F.col(times.get(f.name, f.name)) if times.get(f.name, f.name) in rows.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in service.file_schema.fields
    ])


def raw_by_service(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: raw_trips(spark, sf_dir, name) for name in SERVICE}


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("LocationID"), F.col("s_name").alias("Zone")
    )


def trip_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green trips with the stream message's columns and types."""
    raw = raw_trips(spark, sf_dir, "green")

    def column(field: T.StructField) -> Column:
        if field.name.endswith("_datetime"):
            return F.unix_millis(F.col(field.name).cast("timestamp"))
        return F.col(field.name).cast(field.dataType)

    return raw.select(*[column(f).alias(f.name) for f in TRIP_MESSAGE.fields])
