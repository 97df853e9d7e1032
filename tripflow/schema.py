"""Record layouts and the per-service differences between them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import types as T

from tripflow.functions.keys import plain_number

MONEY = T.DecimalType(38, 9)

# Column names, order and types of the trip files, the harmonised
# table and the stream message. They have to match the files users already hold.
_STRING, _LONG, _TIME = T.StringType(), T.LongType(), T.TimestampType()

_NOTES = {
    "unique_row_id": "Hash of the identifying columns.",
    "filename": "File the record was loaded from.",
    "VendorID": "Code of the data provider.",
    "passenger_count": "Passengers, as entered by the driver.",
    "trip_distance": "Distance in miles, by the meter.",
    "RatecodeID": "Rate code in effect at the end of the trip.",
    "store_and_fwd_flag": "Y when the record was held in the vehicle before sending.",
    "PULocationID": "Zone where the trip began.",
    "DOLocationID": "Zone where the trip ended.",
    "payment_type": "How the trip was paid.",
    "fare_amount": "Time-and-distance fare.",
    "total_amount": "Amount charged, without cash tips.",
    "service_type": "Service the trip belongs to.",
}


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([
        T.StructField(name, kind, True, {"comment": _NOTES[name]} if name in _NOTES else None)
        for name, kind in fields
    ])


YELLOW_FILE = _struct([
    ("VendorID", _STRING),
    ("tpep_pickup_datetime", _TIME),
    ("tpep_dropoff_datetime", _TIME),
    ("passenger_count", _LONG),
    ("trip_distance", MONEY),
    ("RatecodeID", _STRING),
    ("store_and_fwd_flag", _STRING),
    ("PULocationID", _STRING),
    ("DOLocationID", _STRING),
    ("payment_type", _LONG),
    ("fare_amount", MONEY),
    ("extra", MONEY),
    ("mta_tax", MONEY),
    ("tip_amount", MONEY),
    ("tolls_amount", MONEY),
    ("improvement_surcharge", MONEY),
    ("total_amount", MONEY),
    ("congestion_surcharge", MONEY),
])

GREEN_FILE = _struct([
    ("VendorID", _STRING),
    ("lpep_pickup_datetime", _TIME),
    ("lpep_dropoff_datetime", _TIME),
    ("store_and_fwd_flag", _STRING),
    ("RatecodeID", _STRING),
    ("PULocationID", _STRING),
    ("DOLocationID", _STRING),
    ("passenger_count", _LONG),
    ("trip_distance", MONEY),
    ("fare_amount", MONEY),
    ("extra", MONEY),
    ("mta_tax", MONEY),
    ("tip_amount", MONEY),
    ("tolls_amount", MONEY),
    ("ehail_fee", MONEY),
    ("improvement_surcharge", MONEY),
    ("total_amount", MONEY),
    ("payment_type", _LONG),
    ("trip_type", _STRING),
    ("congestion_surcharge", MONEY),
])

TRIP_DATA = _struct([
    ("VendorID", _STRING),
    ("pickup_datetime", _TIME),
    ("dropoff_datetime", _TIME),
    ("store_and_fwd_flag", _STRING),
    ("RatecodeID", _STRING),
    ("PULocationID", _STRING),
    ("DOLocationID", _STRING),
    ("passenger_count", _LONG),
    ("trip_distance", MONEY),
    ("fare_amount", MONEY),
    ("extra", MONEY),
    ("mta_tax", MONEY),
    ("tip_amount", MONEY),
    ("tolls_amount", MONEY),
    ("improvement_surcharge", MONEY),
    ("total_amount", MONEY),
    ("payment_type", _LONG),
    ("congestion_surcharge", MONEY),
    ("service_type", _STRING),
])

TRIP_MESSAGE = _struct([
    ("VendorID", T.IntegerType()),
    ("lpep_pickup_datetime", _LONG),
    ("lpep_dropoff_datetime", _LONG),
    ("store_and_fwd_flag", _STRING),
    ("RatecodeID", T.IntegerType()),
    ("PULocationID", T.IntegerType()),
    ("DOLocationID", T.IntegerType()),
    ("passenger_count", T.IntegerType()),
    ("trip_distance", T.DoubleType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("ehail_fee", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("payment_type", T.IntegerType()),
    ("trip_type", T.IntegerType()),
])



def database_types(schema: T.StructType) -> T.StructType:
    """The layout as a relational database keeps it: doubles, integers, times without a zone."""
    kinds = {T.DecimalType: T.DoubleType(), T.LongType: T.IntegerType(),
             T.TimestampType: T.TimestampNTZType()}
    return T.StructType([
        T.StructField(f.name, kinds.get(type(f.dataType), f.dataType), f.nullable, f.metadata)
        for f in schema.fields
    ])


ZONE_LOOKUP = _struct([("LocationID", _STRING), ("Zone", _STRING)])

EPOCH = "1970-01-01 00:00:00"


@dataclass(frozen=True)
class Service:
    """What distinguishes one taxi service's files from another's."""

    name: str
    time_prefix: str
    file_schema: T.StructType
    ignore_extra_values: bool

    @property
    def pickup(self) -> str:
        return f"{self.time_prefix}_pickup_datetime"

    @property
    def dropoff(self) -> str:
        return f"{self.time_prefix}_dropoff_datetime"

    @property
    def hashed_key(self) -> list[str]:
        """Columns behind the MD5 row id."""
        return ["VendorID", self.pickup, self.dropoff, "PULocationID", "DOLocationID"]

    @property
    def text_key(self) -> list[str | Column]:
        """Columns behind the unhashed row id, amounts as plain numbers."""
        return [*self.hashed_key, plain_number("fare_amount"), plain_number("trip_distance")]

    @property
    def table_schema(self) -> T.StructType:
        return T.StructType([*_struct([("unique_row_id", _STRING), ("filename", _STRING)]).fields,
                             *self.file_schema.fields])

    def table_name(self, year: int | str | None = None, month: int | str | None = None) -> str:
        """``yellow_tripdata``, or ``yellow_tripdata_2019_10`` for one month's staging."""
        period = [str(p).zfill(2) for p in (year, month) if p is not None]
        return "_".join([f"{self.name}_tripdata", *period])

    def file_name(self, year: int | str, month: int | str) -> str:
        return f"{self.name}_tripdata_{year}-{str(month).zfill(2)}.csv.gz"


SERVICE = {
    "yellow": Service("yellow", "tpep", YELLOW_FILE, ignore_extra_values=False),
    "green": Service("green", "lpep", GREEN_FILE, ignore_extra_values=True),
}
