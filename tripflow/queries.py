"""Named queries over the provided tables, and the SQL that gives the same rows.

Exact decimals become doubles only here, at the boundary where results of two
engines are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import fixtures
from tripflow.functions import concat_key, hours_between, json_text, md5_key, millis_to_timestamp
from tripflow.operators import (
    count_bitmaps,
    count_distinct,
    count_rows,
    count_where,
    days_of,
    distinct_bitmaps,
    distinct_values,
    high_water_mark,
    latest_marks,
    least_frequent_zones,
    longest_hours,
    mean_by_group,
    monthly_revenue,
    on_day,
    same_day,
    session_counts,
    session_counts_by_span,
    time_at,
    tumbling_counts,
    union_services,
    with_row_id,
    with_zone,
    zone_counts,
)
from tripflow.plans import (
    harmonize_new_rows,
    load_arrivals,
    load_files_to_tables,
    load_increment,
    merge_into_table,
    project_with_defaults,
    refresh_daily_sums,
    report_from_sums,
    staged_merge,
    write_report,
)
from tripflow.schema import SERVICE, TRIP_DATA, TRIP_MESSAGE
from tripflow.session import shared_dir
from tripflow.sinks import (
    append_table,
    compact_days,
    encode_messages,
    ensure_table,
    replace_table,
    stored,
    truncate_table,
    write_json_lines,
    write_parquet,
)
from tripflow.sources import (
    footer_counts,
    footer_marks,
    read_array_elements,
    read_columns,
    read_csv_files,
    read_file,
    read_parquet_like,
    read_query,
    read_since,
    read_trip_files,
    time_range,
    with_micros,
)
from tripflow.streaming import (
    decode_messages,
    fold_updates,
    read_complete,
    read_sorted,
    read_updated,
    replay_files,
    start_append,
    start_complete,
    start_sorted,
    start_update,
    stream_zone_pair_counts,
    with_event_time,
    with_watermark,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TRIPS = """
trips AS (
  SELECT CAST(l_partkey % 2 + 1 AS VARCHAR) AS VendorID,
    o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_linenumber AS VARCHAR) AS RatecodeID, CAST(l_suppkey AS VARCHAR) AS PULocationID,
    CAST(o_custkey AS VARCHAR) AS DOLocationID, CAST(l_quantity AS INT) AS passenger_count,
    CAST(l_quantity AS DECIMAL(38,9)) AS trip_distance,
    CAST(l_extendedprice AS DECIMAL(38,9)) AS fare_amount,
    CAST(l_discount AS DECIMAL(38,9)) AS extra, CAST(l_tax AS DECIMAL(38,9)) AS mta_tax,
    CAST(l_discount + l_tax AS DECIMAL(38,9)) AS tip_amount,
    CAST(l_partkey % 7 AS DECIMAL(38,9)) AS tolls_amount,
    CAST(0.3 AS DECIMAL(38,9)) AS improvement_surcharge,
    CAST(o_totalprice AS DECIMAL(38,9)) AS total_amount,
    l_linenumber % 6 + 1 AS payment_type,
    CASE WHEN l_suppkey % 3 = 0 THEN CAST(2.5 AS DECIMAL(38,9)) END AS congestion_surcharge,
    CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS service_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

MONEY_COLUMNS = ["trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "improvement_surcharge", "total_amount", "congestion_surcharge"]
MONEY_AS_DOUBLE = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY_COLUMNS)
ALL_TRIP_COLUMNS = f"* REPLACE ({MONEY_AS_DOUBLE})"
ROW_ID_SQL = ("md5(concat(VendorID, CAST(pickup_datetime AS VARCHAR), "
              "CAST(dropoff_datetime AS VARCHAR), PULocationID, DOLocationID))")


def query(oracle: str | None = None, name: str | None = None):
    """Register a query under ``name`` or else its function's name."""
    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        if oracle:
            ORACLES[name or fn.__name__] = oracle.strip()
        return fn
    return register


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and zoned timestamps without a zone."""
    def convert(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)
    return df.select(*[convert(f) for f in df.schema.fields])


def _new_table(spark: SparkSession, label: str) -> tuple[str, str]:
    """An unused table name and the folder for its files."""
    location = shared_dir(spark, label)
    return location.rsplit("/", 1)[1].replace("-", "_"), location


def _whole_numbers_as_int(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in ("passenger_count", "payment_type")})


# --- reports ---------------------------------------------------------------

REVENUE_SQL = """
  PULocationID AS revenue_zone, date_trunc('month', pickup_datetime) AS revenue_month, service_type,
  CAST(SUM(fare_amount) AS DOUBLE) AS revenue_monthly_fare,
  CAST(SUM(extra) AS DOUBLE) AS revenue_monthly_extra,
  CAST(SUM(mta_tax) AS DOUBLE) AS revenue_monthly_mta_tax,
  CAST(SUM(tip_amount) AS DOUBLE) AS revenue_monthly_tip_amount,
  CAST(SUM(tolls_amount) AS DOUBLE) AS revenue_monthly_tolls_amount,
  CAST(SUM(improvement_surcharge) AS DOUBLE) AS revenue_monthly_improvement_surcharge,
  CAST(SUM(total_amount) AS DOUBLE) AS revenue_monthly_total_amount,
  CAST(SUM(congestion_surcharge) AS DOUBLE) AS revenue_monthly_congestion_surcharge,
  AVG(passenger_count) AS avg_monthly_passenger_count,
  CAST(SUM(trip_distance) AS DOUBLE) / COUNT(trip_distance) AS avg_monthly_trip_distance
"""


@query(f"""
WITH {TRIPS} SELECT {REVENUE_SQL} FROM trips
WHERE pickup_datetime >= TIMESTAMP '1996-01-01' AND pickup_datetime < TIMESTAMP '1997-01-01'
GROUP BY ALL""", name="monthly_revenue")
def monthly_revenue_year(spark, sf_dir):
    """The yearly report, half open."""
    return comparable(monthly_revenue(
        fixtures.trips(spark, sf_dir), "1996-01-01", "1997-01-01", half_open=True))


@query(f"""
WITH {TRIPS} SELECT {REVENUE_SQL} FROM trips
WHERE pickup_datetime BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 23:59:59'
GROUP BY ALL""")
def monthly_revenue_between(spark, sf_dir):
    """The report over a range with both ends included."""
    return comparable(monthly_revenue(
        fixtures.trips(spark, sf_dir), "1996-01-01 00:00:00", "1996-12-31 23:59:59"))


@query(f"""
WITH {TRIPS} SELECT {REVENUE_SQL} FROM trips WHERE year(pickup_datetime) = 1998 GROUP BY ALL""")
def report_table(spark, sf_dir):
    """A year's report written to its table, twice, and read back."""
    table, location = _new_table(spark, "report")
    for _ in range(2):
        write_report(fixtures.trips(spark, sf_dir), "1998-01-01", table=table, location=location)
    return comparable(spark.table(table))


@query(f"""
WITH {TRIPS} SELECT {REVENUE_SQL} FROM trips WHERE year(pickup_datetime) = 1997 GROUP BY ALL""")
def report_from_days(spark, sf_dir):
    """A year's report over a table partitioned by day, of which only its days are read."""
    source, place = _new_table(spark, "trip_days")
    ensure_table(spark, source, TRIP_DATA, day_of="pickup_datetime", location=place)
    append_table(fixtures.trips(spark, sf_dir), source, day_of="pickup_datetime")
    table, location = _new_table(spark, "report")
    write_report(spark.table(source), "1997-01-01", table=table, location=location,
                 day_col="pickup_date")
    return comparable(spark.table(table))


@query(f"WITH {TRIPS} SELECT {REVENUE_SQL} FROM trips GROUP BY ALL")
def monthly_revenue_all(spark, sf_dir):
    """The report over everything there is."""
    return comparable(monthly_revenue(
        fixtures.trips(spark, sf_dir), "1900-01-01", "2100-01-01", half_open=True))


# --- exploration -----------------------------------------------------------

@query(f"WITH {TRIPS} SELECT count(*) AS row_count FROM trips")
def count_trips(spark, sf_dir):
    return count_rows(fixtures.trips(spark, sf_dir))


@query(f"WITH {TRIPS} SELECT count(DISTINCT PULocationID) AS distinct_count FROM trips")
def distinct_pickup_zones(spark, sf_dir):
    return count_distinct(fixtures.trips(spark, sf_dir), "PULocationID")


@query(f"WITH {TRIPS} SELECT PULocationID FROM trips")
def pickup_zones(spark, sf_dir):
    return fixtures.trips(spark, sf_dir).select("PULocationID")


@query(f"WITH {TRIPS} SELECT PULocationID, DOLocationID FROM trips")
def zone_pairs(spark, sf_dir):
    return fixtures.trips(spark, sf_dir).select("PULocationID", "DOLocationID")


@query(f"WITH {TRIPS} SELECT count(*) AS row_count FROM trips WHERE mta_tax = 0")
def count_zero_tax(spark, sf_dir):
    return count_where(fixtures.trips(spark, sf_dir), F.col("mta_tax") == 0)


@query(f"WITH {TRIPS} SELECT DISTINCT VendorID FROM trips")
def distinct_vendors(spark, sf_dir):
    return distinct_values(fixtures.trips(spark, sf_dir), "VendorID")


@query(f"""
WITH {TRIPS} SELECT DISTINCT VendorID FROM trips
WHERE dropoff_datetime BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-03-15'""")
def vendors_in_range(spark, sf_dir):
    rows = time_range(fixtures.trips(spark, sf_dir), "dropoff_datetime", "1996-03-01", "1996-03-15")
    return distinct_values(rows, "VendorID")


@query(f"""
WITH {TRIPS} SELECT count(*) AS row_count FROM trips
WHERE CAST(pickup_datetime AS DATE) = CAST(dropoff_datetime AS DATE)""")
def same_day_trips(spark, sf_dir):
    return count_where(fixtures.trips(spark, sf_dir),
                       same_day("pickup_datetime", "dropoff_datetime"))


@query(f"""
WITH {TRIPS} SELECT count(*) AS row_count FROM trips
WHERE CAST(pickup_datetime AS DATE) = DATE '1996-10-15'""")
def trips_on_day(spark, sf_dir):
    return count_where(fixtures.trips(spark, sf_dir), on_day("1996-10-15", "pickup_datetime"))


@query(f"""
WITH {TRIPS} SELECT count(*) AS row_count FROM trips
WHERE CAST(pickup_datetime AS DATE) = DATE '1996-10-15'
  AND CAST(dropoff_datetime AS DATE) = DATE '1996-10-16'""")
def trips_within_day(spark, sf_dir):
    """Both times on one day, dropoff times being moved back by a day."""
    trips = fixtures.trips(spark, sf_dir).withColumn(
        "dropoff_datetime", F.col("dropoff_datetime") - F.expr("INTERVAL 1 DAY"))
    return count_where(trips, on_day("1996-10-15", "pickup_datetime", "dropoff_datetime"))


@query(f"""
WITH {TRIPS} SELECT max((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 3600.0)
  AS longest_hours FROM trips""")
def longest_trip_hours(spark, sf_dir):
    return longest_hours(fixtures.trips(spark, sf_dir), "pickup_datetime", "dropoff_datetime")


@query(f"""
WITH {TRIPS} SELECT VendorID, pickup_datetime, dropoff_datetime,
  CAST((epoch(dropoff_datetime) - epoch(pickup_datetime)) / 3600.0 AS DOUBLE) AS hours FROM trips""")
def trip_durations(spark, sf_dir):
    return fixtures.trips(spark, sf_dir).select(
        "VendorID", "pickup_datetime", "dropoff_datetime",
        hours_between("pickup_datetime", "dropoff_datetime").alias("hours"))


ZONES_JOIN = """
FROM trips JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS LocationID, s_name AS Zone FROM supplier)
  ON PULocationID = LocationID"""


@query(f"WITH {TRIPS} SELECT Zone, count(*) AS trip_count {ZONES_JOIN} GROUP BY Zone")
def zone_trip_counts(spark, sf_dir):
    return zone_counts(fixtures.trips(spark, sf_dir), fixtures.zones(spark, sf_dir))


@query(f"""
WITH {TRIPS} SELECT Zone, count(*) AS trip_count {ZONES_JOIN}
GROUP BY Zone ORDER BY trip_count, Zone LIMIT 1""")
def least_frequent_zone(spark, sf_dir):
    return least_frequent_zones(fixtures.trips(spark, sf_dir), fixtures.zones(spark, sf_dir))


@query(f"""
WITH {TRIPS} SELECT trips.* REPLACE ({MONEY_AS_DOUBLE}), Zone {ZONES_JOIN}""")
def trips_with_zone(spark, sf_dir):
    return comparable(with_zone(fixtures.trips(spark, sf_dir), fixtures.zones(spark, sf_dir)))


@query(f"""
WITH {TRIPS} SELECT service_type, count(*) AS trip_count FROM trips
WHERE service_type IN ('yellow', 'green') GROUP BY service_type""")
def trips_per_service(spark, sf_dir):
    """An SQL text as the source."""
    return read_query(
        spark,
        "SELECT service_type, count(*) AS trip_count FROM {trips} "
        "WHERE service_type IN ('yellow', 'green') GROUP BY service_type",
        trips=fixtures.trips(spark, sf_dir))


# --- incremental loading ---------------------------------------------------

LOADED_SQL = """loaded AS (SELECT * FROM trips WHERE pickup_datetime <
  CASE service_type WHEN 'yellow' THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '1999-01-01' END)"""
MARKS_SQL = """marks AS (
  SELECT s.service_type, coalesce(max(pickup_datetime), TIMESTAMP '1970-01-01') AS latest_datetime
  FROM (VALUES ('yellow'), ('green'), ('fhv')) AS s(service_type)
  LEFT JOIN loaded ON loaded.service_type = s.service_type GROUP BY s.service_type)"""


def _loaded(spark, sf_dir):
    """A target that has been loaded up to a different time for each service."""
    return _up_to_marks(fixtures.trips(spark, sf_dir))


def _up_to_marks(trips):
    until = F.when(F.col("service_type") == "yellow", F.lit("2000-01-01")).otherwise("1999-01-01")
    return trips.where(F.col("pickup_datetime") < until.cast("timestamp_ntz"))


@query(f"WITH {TRIPS}, {LOADED_SQL}, {MARKS_SQL} SELECT * FROM marks",
       name="high_water_mark")
def high_water_marks(spark, sf_dir):
    return comparable(high_water_mark(_loaded(spark, sf_dir), ["yellow", "green", "fhv"]))


@query(f"""
WITH {TRIPS}, {LOADED_SQL}, {MARKS_SQL}
SELECT service_type, count(*) AS row_count FROM trips JOIN marks USING (service_type)
WHERE pickup_datetime > latest_datetime GROUP BY service_type""")
def incremental_rows(spark, sf_dir):
    new = harmonize_new_rows(fixtures.raw_by_service(spark, sf_dir), _loaded(spark, sf_dir))
    return new.groupBy("service_type").agg(F.count(F.lit(1)).alias("row_count"))


@query(f"""
WITH {TRIPS}, {LOADED_SQL}, {MARKS_SQL}
SELECT {ALL_TRIP_COLUMNS} FROM (
  SELECT * FROM loaded UNION ALL
  SELECT trips.* FROM trips JOIN marks USING (service_type)
  WHERE pickup_datetime > latest_datetime)""")
def incremental_load(spark, sf_dir):
    """The target table after the job; a service it does not know is passed over."""
    table, location = _new_table(spark, "trip_data")
    ensure_table(spark, table, TRIP_DATA, location=location)
    append_table(_loaded(spark, sf_dir), table)
    raw = fixtures.raw_by_service(spark, sf_dir)
    load_increment(spark, {**raw, "fhv": spark.range(1)}, table)
    return comparable(_whole_numbers_as_int(spark.table(table)))


@query(f"""
WITH {TRIPS}, {LOADED_SQL}, {MARKS_SQL}
SELECT {ALL_TRIP_COLUMNS}, CAST(pickup_datetime AS DATE) AS pickup_date FROM (
  SELECT * FROM loaded UNION ALL
  SELECT trips.* FROM trips JOIN marks USING (service_type)
  WHERE pickup_datetime > latest_datetime)""")
def incremental_load_by_day(spark, sf_dir):
    """The same into a table partitioned by day, by twenty tasks."""
    table, location = _new_table(spark, "trip_data")
    ensure_table(spark, table, TRIP_DATA, day_of="pickup_datetime", location=location)
    trips = fixtures.as_trips(stored(fixtures.lines(spark, sf_dir), "lines"))
    append_table(_up_to_marks(trips), table, day_of="pickup_datetime")
    load_increment(spark, {name: fixtures.as_raw(trips, name) for name in SERVICE}, table, by_day=True,
                   partitions=20)
    return comparable(_whole_numbers_as_int(spark.table(table)))


LATE_ID_SQL = """concat_ws('|', service_type, VendorID, CAST(pickup_datetime AS VARCHAR),
  CAST(dropoff_datetime AS VARCHAR), PULocationID, DOLocationID)"""


@query(f"""
WITH {TRIPS}, first_load AS (SELECT * FROM trips
  WHERE pickup_datetime < TIMESTAMP '1999-01-01' AND CAST(PULocationID AS INT) % 3 > 0),
marks AS (SELECT service_type, max(pickup_datetime) AS mark FROM first_load GROUP BY service_type)
SELECT {ALL_TRIP_COLUMNS} FROM first_load
UNION ALL SELECT trips.* REPLACE ({MONEY_AS_DOUBLE}) FROM trips JOIN marks USING (service_type)
WHERE pickup_datetime > mark - INTERVAL 200 DAY AND NOT EXISTS (
  SELECT 1 FROM (SELECT {LATE_ID_SQL} AS id FROM first_load) t
  WHERE t.id = {LATE_ID_SQL.replace("service_type", "trips.service_type")})""")
def lookback_late_rows(spark, sf_dir):
    """Rows that came late, found by reading a span before the marks again."""
    table, location = _new_table(spark, "trip_data")
    trips = fixtures.trips(spark, sf_dir)
    early = F.col("pickup_datetime") < F.lit("1999-01-01").cast("timestamp_ntz")
    ensure_table(spark, table, TRIP_DATA, location=location)
    append_table(trips.where(early & (F.col("PULocationID").cast("int") % 3 > 0)), table)
    load_increment(spark, fixtures.raw_by_service(spark, sf_dir), table,
                   lookback=timedelta(days=200))
    return comparable(_whole_numbers_as_int(spark.table(table)))


@query(f"""
WITH {TRIPS} SELECT {ALL_TRIP_COLUMNS} FROM trips
WHERE service_type = 'yellow' AND pickup_datetime >
  (SELECT max(pickup_datetime) - INTERVAL 365 DAY FROM trips WHERE service_type = 'yellow')""")
def rows_since(spark, sf_dir):
    """A scan from a mark on; the mark is one scalar."""
    trips = fixtures.trips(spark, sf_dir)
    yellow = trips.where(F.col("service_type") == "yellow")
    mark = yellow.agg((F.max("pickup_datetime") - F.expr("INTERVAL 365 DAYS"))
                      .cast("string").alias("mark")).first()["mark"]
    return comparable(read_since(yellow, "pickup_datetime", mark))


@query(f"WITH {TRIPS} SELECT {ALL_TRIP_COLUMNS} FROM trips")
def harmonized_union(spark, sf_dir):
    return comparable(union_services(fixtures.raw_by_service(spark, sf_dir)))


# --- row ids and merging ---------------------------------------------------

KEY = ["VendorID", "pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"]


@query(f"WITH {TRIPS} SELECT {ROW_ID_SQL} AS unique_row_id FROM trips")
def row_id_md5(spark, sf_dir):
    return fixtures.trips(spark, sf_dir).select(md5_key(KEY).alias("unique_row_id"))


PLAIN_NUMBER_SQL = r"regexp_replace(CAST({} AS VARCHAR), '\.?0+$', '')"


@query(f"""
WITH {TRIPS} SELECT service_type, concat(VendorID, CAST(pickup_datetime AS VARCHAR),
  CAST(dropoff_datetime AS VARCHAR), PULocationID, DOLocationID,
  {PLAIN_NUMBER_SQL.format("fare_amount")}, {PLAIN_NUMBER_SQL.format("trip_distance")}
  ) AS unique_row_id FROM trips""")
def row_id_concat(spark, sf_dir):
    """The unhashed ids of both services' raw rows."""
    ids = [fixtures.raw_trips(spark, sf_dir, name).select(
        F.lit(name).alias("service_type"), concat_key(service.text_key).alias("unique_row_id"))
        for name, service in SERVICE.items()]
    return ids[0].unionByName(ids[1])


@query(f"""
WITH {TRIPS} SELECT {ROW_ID_SQL} AS unique_row_id,
  'trips.csv' AS filename, {ALL_TRIP_COLUMNS} FROM trips""")
def staged_rows(spark, sf_dir):
    """Staging: row id and file name in front of the raw columns."""
    return comparable(with_row_id(fixtures.trips(spark, sf_dir), KEY, "trips.csv"))


@query(f"""
WITH {TRIPS}, keyed AS (SELECT {ROW_ID_SQL} AS unique_row_id, {ALL_TRIP_COLUMNS} FROM trips),
target AS (SELECT unique_row_id, 'before.csv' AS filename, * EXCLUDE (unique_row_id) FROM keyed
  WHERE pickup_datetime < TIMESTAMP '1999-01-01'),
stage AS (SELECT unique_row_id, 'after.csv' AS filename, * EXCLUDE (unique_row_id) FROM keyed
  WHERE pickup_datetime >= TIMESTAMP '1998-01-01')
SELECT * FROM target UNION ALL
SELECT * FROM stage s WHERE NOT EXISTS (
  SELECT 1 FROM target t WHERE t.unique_row_id = s.unique_row_id)""", name="staged_merge")
def staged_merge_result(spark, sf_dir):
    """The target after a merge whose staging overlaps it by a year."""
    trips = fixtures.trips(spark, sf_dir)
    day = F.to_date("pickup_datetime")
    target = with_row_id(time_range(trips, "pickup_datetime", "1900-01-01", "1999-01-01",
                                    half_open=True), KEY, "before.csv")
    raw = time_range(trips, "pickup_datetime", "1998-01-01", "2100-01-01", half_open=True)
    new = staged_merge(raw, target, KEY, "after.csv", time_col="pickup_datetime", target_day=day)
    return comparable(target.unionByName(new))


MERGED_COLUMNS = f"""service_type, VendorID, pickup_datetime, dropoff_datetime, store_and_fwd_flag,
  RatecodeID, PULocationID, DOLocationID, passenger_count, {MONEY_AS_DOUBLE}, payment_type,
  CAST(NULL AS DOUBLE) AS ehail_fee, CAST(NULL AS INT) AS trip_type"""
MERGED_TABLES_SQL = f"""
WITH {TRIPS}, keyed AS (SELECT {ROW_ID_SQL} AS unique_row_id, * FROM trips),
target AS (SELECT * FROM keyed WHERE pickup_datetime < TIMESTAMP '1999-01-01')
SELECT unique_row_id, 'before.csv' AS filename, {MERGED_COLUMNS} FROM target
UNION ALL
SELECT unique_row_id, 'all.csv', {MERGED_COLUMNS}
FROM keyed s WHERE NOT EXISTS (SELECT 1 FROM target t
  WHERE t.unique_row_id = s.unique_row_id AND t.service_type = s.service_type)"""


def _merged_tables(spark, sf_dir, **layout):
    """Both services' tables, all columns, after a load and a second one that contains it."""
    results = []
    for name, service in SERVICE.items():
        raw = fixtures.raw_trips(spark, sf_dir, name)
        table, location = _new_table(spark, service.table_name())
        before = time_range(raw, service.pickup, "1900-01-01", "1999-01-01", half_open=True)
        for rows, source in ((before, "before.csv"), (raw, "all.csv")):
            merge_into_table(spark, rows, table, name, source, location=location, **layout)
        neutral = {service.pickup: "pickup_datetime", service.dropoff: "dropoff_datetime"}
        stored = spark.table(table).drop("pickup_date").withColumnsRenamed(neutral)
        results.append(stored.withColumn("service_type", F.lit(name)))
    both = results[0].unionByName(results[1], allowMissingColumns=True)
    return comparable(_whole_numbers_as_int(both).withColumn(
        "trip_type", F.col("trip_type").cast("int")))


@query(MERGED_TABLES_SQL)
def staged_merge_tables(spark, sf_dir):
    return _merged_tables(spark, sf_dir, by_day=False)


@query(MERGED_TABLES_SQL)
def staged_merge_by_day(spark, sf_dir):
    """The same into tables partitioned by day, as the job runs by default."""
    return _merged_tables(spark, sf_dir, by_day=True)


@query(MERGED_TABLES_SQL)
def staged_merge_bucketed(spark, sf_dir):
    """The same into tables in buckets by row id, of which merges move nothing."""
    return _merged_tables(spark, sf_dir, buckets=16)


# --- JSON documents --------------------------------------------------------

@query("""
SELECT event_id,
  CASE WHEN json_exists(props, '$.k') THEN props ->> '$.k' ELSE 'N/A' END AS k,
  CASE WHEN json_exists(props, '$.brand') THEN props ->> '$.brand' ELSE 'N/A' END AS brand
FROM events""")
def json_project_default(spark, sf_dir):
    return project_with_defaults(fixtures.table(spark, sf_dir, "events"),
                                 F.try_parse_json("props"), ["k", "brand"], keep=["event_id"])


@query("""
SELECT p_brand AS brand, CAST(p_size AS VARCHAR) AS size FROM part
UNION ALL SELECT 'N/A', CAST(p_partkey AS VARCHAR) FROM part
UNION ALL SELECT NULL, 'N/A' FROM part""")
def product_arrays(spark, sf_dir):
    """Documents holding arrays of products, written, read back and projected.

    Each document has a complete product, one without a brand, and one whose brand
    is null and which has no size.
    """
    part = fixtures.table(spark, sf_dir, "part")
    products = F.concat_ws(
        ",",
        json_text(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")),
        json_text(F.col("p_partkey").alias("size")),
        F.lit('{"brand":null}'),
    )
    path = shared_dir(spark, "products")
    part.select(F.concat(F.lit('{"products":['), products, F.lit("]}"))).write.text(path)
    elements = read_array_elements(spark, path, "products", alias="product")
    return project_with_defaults(elements, F.col("product"), ["brand", "size"])


@query("SELECT event_type, round(avg(value), 2) AS avg_value FROM events GROUP BY event_type")
def avg_by_group_rounded(spark, sf_dir):
    return mean_by_group(fixtures.table(spark, sf_dir, "events"), "event_type", "value")


# --- windows ---------------------------------------------------------------

EVENT_WINDOWS_SQL = """
SELECT user_id, event_type, count(*) AS event_count, min(event_id) AS first_id,
  max(event_id) AS last_id, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end
FROM events GROUP BY ALL"""
EVENT_NAMES = {"count_alias": "event_count", "low_alias": "first_id", "high_alias": "last_id",
               "with_bounds": True}
EVENT_KEYS = ["user_id", "event_type"]


@query(EVENT_WINDOWS_SQL, name="tumbling_counts")
def tumbling_event_counts(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    return comparable(tumbling_counts(events, "ts", EVENT_KEYS, "event_id", **EVENT_NAMES))


@query("""
WITH e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events)
SELECT user_id, count(*) AS trip_count, min(ms) AS start_time, max(ms) AS end_time
FROM e GROUP BY user_id, time_bucket(INTERVAL 5 MINUTE, make_timestamp((ms // 1000) * 1000000))""")
def tumbling_counts_ms(spark, sf_dir):
    """Event time derived from epoch milliseconds."""
    events = fixtures.table(spark, sf_dir, "events").select(
        "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return tumbling_counts(with_event_time(events, "ms"), "event_time", ["user_id"], "ms")


def _sessions_sql(closed: str = "") -> str:
    return f"""
WITH ordered AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events),
numbered AS (SELECT *, sum(CASE WHEN ts - before <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END)
  OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM ordered),
sessions AS (SELECT user_id, session, count(*) AS event_count, min(event_id) AS first_id,
  max(event_id) AS last_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end
  FROM numbered GROUP BY user_id, session)
SELECT * EXCLUDE (session) FROM sessions {closed}"""


SESSION_NAMES = {"count_alias": "event_count", "low_alias": "first_id", "high_alias": "last_id"}


@query(_sessions_sql())
def session_event_counts(spark, sf_dir):
    """A user's events until none comes for half an hour."""
    events = fixtures.table(spark, sf_dir, "events")
    return comparable(session_counts_by_span(events, "ts", ["user_id"], "event_id", "30 minutes",
                                             **SESSION_NAMES))


# --- streaming -------------------------------------------------------------

def _event_stream(spark, sf_dir):
    schema = fixtures.table(spark, sf_dir, "events").schema
    return replay_files(spark, f"{sf_dir}/events.parquet", schema, single_file=True)


def _event_stream_counts(spark, sf_dir):
    return stream_zone_pair_counts(_event_stream(spark, sf_dir), event_time="ts",
                                   keys=EVENT_KEYS, bound="event_id", **EVENT_NAMES)


def _run(start, df, label):
    """Run a stream to the end of its input; the frame of what it wrote."""
    spark = df.sparkSession
    out = shared_dir(spark, label)
    start(df, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return comparable(spark.read.parquet(f"{out}/rows"))


@query(EVENT_WINDOWS_SQL)
def stream_tumbling_counts(spark, sf_dir):
    """Every window, open ones included."""
    out = shared_dir(spark, "stream-counts")
    start_complete(_event_stream_counts(spark, sf_dir), f"{out}/rows",
                   f"{out}/checkpoint").awaitTermination()
    return comparable(read_complete(spark, f"{out}/rows"))


@query(f"""
SELECT * FROM ({EVENT_WINDOWS_SQL})
WHERE window_end <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)""")
def stream_tumbling_append(spark, sf_dir):
    """The windows the watermark has closed."""
    return _run(start_append, _event_stream_counts(spark, sf_dir), "stream-append")


@query(f"""
SELECT user_id, event_type, event_count FROM ({EVENT_WINDOWS_SQL})
WHERE window_end <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)""")
def stream_sql_counts(spark, sf_dir):
    """The windows counted by SQL over a named stream."""
    name = shared_dir(spark, "events").rsplit("/", 1)[1].replace("-", "_")
    with_watermark(_event_stream(spark, sf_dir), "ts").createOrReplaceTempView(name)
    counts = read_query(spark, f"""
        SELECT user_id, event_type, count(*) AS event_count FROM {name}
        GROUP BY user_id, event_type, window(ts, '5 minutes')""")
    found = _run(start_append, counts, "stream-sql")
    spark.catalog.dropTempView(name)
    return found


@query(_sessions_sql("WHERE session_end <= (SELECT max(ts) - INTERVAL 5 SECOND FROM events)"))
def stream_session_counts(spark, sf_dir):
    """The sessions that the watermark has closed."""
    timed = with_watermark(_event_stream(spark, sf_dir), "ts")
    counts = session_counts(timed, "ts", ["user_id"], "event_id", "30 minutes", **SESSION_NAMES)
    return _run(start_append, counts, "stream-sessions")


MESSAGES_SQL = """
messages AS (
  SELECT CAST(VendorID AS INT) AS VendorID, epoch_ms(pickup_datetime) AS lpep_pickup_datetime,
    epoch_ms(dropoff_datetime) AS lpep_dropoff_datetime, store_and_fwd_flag,
    CAST(RatecodeID AS INT) AS RatecodeID, CAST(PULocationID AS INT) AS PULocationID,
    CAST(DOLocationID AS INT) AS DOLocationID, passenger_count,
    CAST(trip_distance AS DOUBLE) AS trip_distance, CAST(fare_amount AS DOUBLE) AS fare_amount,
    CAST(extra AS DOUBLE) AS extra, CAST(mta_tax AS DOUBLE) AS mta_tax,
    CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(tolls_amount AS DOUBLE) AS tolls_amount,
    CAST(NULL AS DOUBLE) AS ehail_fee, CAST(improvement_surcharge AS DOUBLE) AS improvement_surcharge,
    CAST(total_amount AS DOUBLE) AS total_amount, payment_type, CAST(NULL AS INT) AS trip_type,
    dropoff_datetime AS event_time
  FROM trips WHERE service_type = 'green'
)"""


def _message_stream(spark, sf_dir):
    """Green trips as JSON messages in files, replayed as a stream and decoded."""
    path = shared_dir(spark, "messages")
    messages = encode_messages(fixtures.trip_messages(spark, sf_dir))
    messages.select(F.col("value").cast("string")).write.text(path)
    stream = replay_files(spark, path, fmt="text")
    return with_event_time(decode_messages(stream, TRIP_MESSAGE), "lpep_dropoff_datetime")


@query(f"WITH {TRIPS}, {MESSAGES_SQL} SELECT * FROM messages")
def stream_json_decode(spark, sf_dir):
    return _run(start_append, _message_stream(spark, sf_dir), "stream-decode")


@query(f"""
WITH {TRIPS}, {MESSAGES_SQL}
SELECT strftime(make_timestamp(lpep_pickup_datetime * 1000), '%Y-%m-%dT%H:%M:%S.000')
    AS lpep_pickup_datetime,
  strftime(event_time, '%Y-%m-%dT%H:%M:%S.000') AS lpep_dropoff_datetime, PULocationID, DOLocationID, passenger_count, trip_distance, tip_amount FROM messages""")
def stream_csv_replay(spark, sf_dir):
    """A CSV file's columns sent as JSON messages and decoded from a stream."""
    landed, sent = shared_dir(spark, "green-csv"), shared_dir(spark, "green-messages")
    fixtures.raw_trips(spark, sf_dir, "green").write.csv(landed, header=True)
    columns = ["lpep_pickup_datetime", "lpep_dropoff_datetime", "PULocationID", "DOLocationID",
               "passenger_count", "trip_distance", "tip_amount"]
    encode_messages(read_columns(spark, landed, columns)).select(
        F.col("value").cast("string")).write.text(sent)
    layout = T.StructType([
        T.StructField(f.name, T.StringType() if f.name.endswith("_datetime") else f.dataType)
        for f in TRIP_MESSAGE.fields if f.name in columns])
    decoded = decode_messages(replay_files(spark, sent, fmt="text"), layout)
    return _run(start_append, decoded, "csv-replay")


@query(f"""
WITH {TRIPS}, {MESSAGES_SQL}
SELECT PULocationID, DOLocationID, count(*) AS trip_count,
  min(lpep_dropoff_datetime) AS start_time, max(lpep_dropoff_datetime) AS end_time
FROM messages GROUP BY PULocationID, DOLocationID, time_bucket(INTERVAL 5 MINUTE, event_time)
HAVING time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE <=
  (SELECT max(event_time) - INTERVAL 5 SECOND FROM messages)""")
def stream_zone_pairs(spark, sf_dir):
    """The whole job: messages, event time, watermark, windows per zone pair."""
    counts = stream_zone_pair_counts(_message_stream(spark, sf_dir))
    return _run(start_append, counts, "stream-pairs")


EVENT_TEXT = """concat('{"event_id":', event_id, ',"user_id":', user_id,
  CASE WHEN event_id % 50 = 9 THEN '' ELSE concat(',"ts":', {millis}) END,
  CASE WHEN event_id % 50 = 7 THEN '' ELSE '}' END)"""


@query(f"""
WITH e AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS n FROM events),
sent AS (SELECT {EVENT_TEXT.replace("{millis}", "epoch_us(ts) // 1000")} AS value,
  CASE WHEN event_id % 50 IN (7, 9) THEN NULL
    ELSE make_timestamp((epoch_us(ts) // 1000000) * 1000000) END AS t,
  CASE WHEN event_id % 10 = 3 THEN 3 WHEN ts < (SELECT ts FROM e WHERE n =
    (SELECT count(*) // 2 FROM e)) THEN 1 ELSE 2 END AS batch FROM events),
marked AS (SELECT *, (SELECT max(t) - INTERVAL 5 SECOND FROM sent s WHERE s.batch < sent.batch) AS mark
  FROM sent)
SELECT value, CASE WHEN t IS NULL THEN 'undecodable'
  WHEN time_bucket(INTERVAL 5 MINUTE, t) + INTERVAL 5 MINUTE <= mark THEN 'late' ELSE 'kept' END AS kind
FROM marked""")
def stream_sorted_rows(spark, sf_dir):
    """Messages of three batches, all of them: kept, late behind the watermark, or not decodable."""
    events = fixtures.table(spark, sf_dir, "events")
    half = time_at(events, "ts", events.count() // 2 - 1)
    late, early = F.col("event_id") % 10 == 3, F.col("ts") < F.lit(half)
    text = F.expr(EVENT_TEXT.replace("{millis}", "unix_millis(cast(ts as timestamp))")).alias("value")
    layout = T.StructType([T.StructField(c, T.LongType()) for c in ("event_id", "user_id", "ts")])
    out = shared_dir(spark, "stream-sorted")
    for rows in (events.where(~late & early), events.where(~late & ~early), events.where(late)):
        rows.select(text).write.mode("append").text(f"{out}/in")
        decoded = decode_messages(replay_files(spark, f"{out}/in", fmt="text"), layout, keep=["value"])
        timed = decoded.withColumn("event_time", millis_to_timestamp("ts"))
        start_sorted(timed, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return read_sorted(spark, f"{out}/rows").select("value", "kind")


@query(EVENT_WINDOWS_SQL)
def stream_updated_windows(spark, sf_dir):
    """Windows kept up to date over three batches, the first two folded together on the way."""
    events = fixtures.table(spark, sf_dir, "events")
    out = shared_dir(spark, "stream-updates")
    keys = [*EVENT_KEYS, "window_start", "window_end"]
    for load in range(3):
        events.where(F.col("event_id") % 3 == load).write.mode("append").parquet(f"{out}/in")
        # No event is late behind so long a delay.
        counts = stream_zone_pair_counts(
            replay_files(spark, f"{out}/in", events.schema), "3650 days", event_time="ts",
            keys=EVENT_KEYS, bound="event_id", **EVENT_NAMES)
        start_update(counts, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
        if load == 1:
            fold_updates(spark, f"{out}/rows", keys)
    return comparable(read_updated(spark, f"{out}/rows", keys).drop("load_batch"))


@query(f"WITH {TRIPS} SELECT {ALL_TRIP_COLUMNS} FROM trips")
def arrival_load(spark, sf_dir):
    """Both services' files, loaded as they arrive in three rounds without any order of time."""
    table, location = _new_table(spark, "arrivals")
    out = shared_dir(spark, "landed")
    trip = fixtures.trip_columns()
    lines = stored(fixtures.lines(spark, sf_dir).withColumns(
        {"service": trip["service_type"], "load": trip["passenger_count"] % 3}), "lines", ["service", "load"])

    def land(load: int, name: str) -> None:
        rows = lines.where((F.col("service") == name) & (F.col("load") == load))
        fixtures.as_raw(fixtures.as_trips(rows), name).write.mode("append").csv(f"{out}/{name}", header=True)

    arrivals = [(load, name) for load in range(3) for name in SERVICE]
    with ThreadPoolExecutor(1) as pool:
        landing = pool.submit(land, *arrivals[0])
        for n, (_, name) in enumerate(arrivals, 1):
            landing.result()
            if n < len(arrivals):
                # The other service's files land while this one's are loaded.
                landing = pool.submit(land, *arrivals[n])
            load_arrivals(spark, f"{out}/{name}", name, table, f"{out}/checkpoint-{name}",
                          location=location).awaitTermination()
    loaded = spark.table(table).drop("load_source", "load_batch")
    return comparable(_whole_numbers_as_int(loaded))


# --- kept up by day --------------------------------------------------------

@query(f"""
WITH {TRIPS} SELECT {REVENUE_SQL} FROM trips WHERE year(pickup_datetime) = 1996 GROUP BY ALL""")
def report_from_daily_sums(spark, sf_dir):
    """A year's report from sums per day, of which those of late rows' days were computed anew."""
    table, location = _new_table(spark, "trip_days")
    sums = shared_dir(spark, "daily-sums")
    trips = time_range(fixtures.trips(spark, sf_dir), "pickup_datetime", "1996-01-01", "1997-01-01",
                       half_open=True)
    late = (F.col("payment_type") == 2) & (F.month("pickup_datetime") == 10)
    ensure_table(spark, table, TRIP_DATA, day_of="pickup_datetime", location=location)
    append_table(trips.where(~late), table, day_of="pickup_datetime")
    refresh_daily_sums(spark.table(table), sums)
    append_table(trips.where(late), table, day_of="pickup_datetime")
    changed = days_of(trips.where(late), F.to_date("pickup_datetime"))
    refresh_daily_sums(spark.table(table), sums, changed)
    return comparable(report_from_sums(spark.read.parquet(sums)))


@query(f"""
WITH {TRIPS} SELECT year(pickup_datetime) AS pickup_year, count(DISTINCT PULocationID) AS distinct_zones
FROM trips GROUP BY ALL""")
def distinct_zones_by_year(spark, sf_dir):
    """Distinct zones of each year from stored bitmaps per day."""
    trips = fixtures.trips(spark, sf_dir)
    bitmaps = stored(distinct_bitmaps(trips, F.col("PULocationID"), [F.to_date("pickup_datetime").alias("day")]),
                     "zone-bitmaps")
    return count_bitmaps(bitmaps.withColumn("pickup_year", F.year("day")), ["pickup_year"], "distinct_zones")


@query(f"""
WITH {TRIPS} SELECT service_type, count(*) AS row_count, max(epoch_us(pickup_datetime)) AS mark
FROM trips GROUP BY service_type""")
def counts_and_marks_from_footers(spark, sf_dir):
    """Rows and the latest pickup of each service, from footers alone."""
    path = shared_dir(spark, "by-service")
    with_micros(fixtures.trips(spark, sf_dir), "pickup_datetime").write.partitionBy("service_type").parquet(path)
    marks = footer_marks(spark, path, list(SERVICE))
    times = spark.createDataFrame(list(marks.items()), "service_type string, mark string").select(
        "service_type", F.unix_micros(F.col("mark").cast("timestamp")).alias("mark"))
    return footer_counts(spark, path, ["service_type"]).join(times, "service_type")


# --- layout of tables ------------------------------------------------------

@query("SELECT *, CAST(ts AS DATE) AS event_day FROM events")
def compacted_days(spark, sf_dir):
    """A table by day, filled in four loads, after its small files were joined."""
    events = fixtures.table(spark, sf_dir, "events")
    table, location = _new_table(spark, "events_by_day")
    ensure_table(spark, table, events.schema, day_of="ts", day_col="event_day", location=location)
    for load in range(4):
        append_table(events.where(F.col("event_id") % 4 == load), table, day_of="ts", day_col="event_day")
    compact_days(spark, table, "event_day", ["user_id"])
    return comparable(spark.table(table))


@query(f"""
WITH {TRIPS} SELECT {ALL_TRIP_COLUMNS} FROM trips WHERE service_type = 'green' OR payment_type < 4""")
def replaced_by_own_rows(spark, sf_dir):
    """A table replaced by some of its own rows, after a replace that fails half-way."""
    table, location = _new_table(spark, "own_rows")
    trips = fixtures.trips(spark, sf_dir)
    replace_table(trips, table, location=location)
    broken = F.when(F.col("payment_type") == 6, F.raise_error(F.lit("broken"))).otherwise(F.col("VendorID"))
    try:
        replace_table(spark.table(table).withColumn("VendorID", broken.cast("string")), table,
                      location=location)
    except PySparkException:
        pass
    replace_table(spark.table(table).where((F.col("service_type") == "green") | (F.col("payment_type") < 4)), table,
                  location=location)
    return comparable(spark.table(table))


# --- writing and reading back ----------------------------------------------

@query(f"""
WITH {TRIPS} SELECT DISTINCT VendorID FROM trips
WHERE dropoff_datetime BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-03-15'""")
def partition_pruned_scan(spark, sf_dir):
    """Distinct vendors of a fortnight from a table partitioned by day, clustered by vendor."""
    trips = fixtures.trips(spark, sf_dir)
    name, location = _new_table(spark, "by_day")
    ensure_table(spark, name, trips.schema, day_of="dropoff_datetime", day_col="dropoff_date",
                 location=location)
    append_table(trips, name, day_of="dropoff_datetime", day_col="dropoff_date",
                 cluster_by=["VendorID"])
    rows = time_range(spark.table(name), "dropoff_datetime", "1996-03-01", "1996-03-15",
                      "dropoff_date")
    return distinct_values(rows, "VendorID")


@query(f"WITH {TRIPS} SELECT {ALL_TRIP_COLUMNS} FROM trips")
def csv_gz_roundtrip(spark, sf_dir):
    """Both services' gzipped files under their declared schemas, harmonised again."""
    raw = {}
    for name, service in SERVICE.items():
        path = shared_dir(spark, f"{name}-csv")
        (fixtures.raw_trips(spark, sf_dir, name).write
         .option("header", True).option("compression", "gzip").csv(path))
        raw[name] = read_trip_files(spark, path, service)
    trips = union_services(raw)
    return comparable(_whole_numbers_as_int(trips))


TEXT_COLUMNS = ", ".join(
    [f"strftime({c}, '%Y-%m-%dT%H:%M:%S.000') AS {c}" for c in ("pickup_datetime", "dropoff_datetime")]
    + [f"CAST({c} AS VARCHAR) AS {c}" for c in ("passenger_count", "payment_type")]
    # A decimal zero of nine places is written so.
    + [f"CASE WHEN {c} = 0 THEN '0E-9' ELSE CAST({c} AS VARCHAR) END AS {c}" for c in MONEY_COLUMNS])


@query(f"""
WITH {TRIPS} SELECT * REPLACE ({TEXT_COLUMNS}), service_type || '.csv' AS filename FROM trips""")
def csv_text_columns(spark, sf_dir):
    """CSV read without a schema, with the file's name: every column is text."""
    landed = shared_dir(spark, "text-csv")
    for name in SERVICE:
        rows = fixtures.trips(spark, sf_dir).where(F.col("service_type") == name)
        rows.write.csv(f"{landed}/{name}.csv", header=True)
    text = read_csv_files(spark, [f"{landed}/{name}.csv" for name in SERVICE])
    # Spark names the files of a folder by itself.
    folder = F.element_at(F.split(F.input_file_name(), "/"), -2)
    return text.where(F.col("filename").startswith("part-")).withColumn("filename", folder)


@query(f"""
WITH {TRIPS} SELECT {ALL_TRIP_COLUMNS} FROM trips WHERE service_type = 'green'""")
def green_extra_values(spark, sf_dir):
    """Green files whose rows have more values than columns: the extras are ignored."""
    path = shared_dir(spark, "green-extra")
    raw = fixtures.raw_trips(spark, sf_dir, "green")
    raw.withColumns({"extra_1": F.lit("x"), "extra_2": F.lit(5)}).write.csv(path, header=True)
    read = read_trip_files(spark, path, SERVICE["green"])
    return comparable(_whole_numbers_as_int(union_services({"green": read})))


@query(f"WITH {TRIPS} SELECT PULocationID, CAST(trip_distance AS DOUBLE) AS trip_distance FROM trips")
def csv_column_subset(spark, sf_dir):
    """Two columns of a wider CSV file."""
    path = shared_dir(spark, "wide-csv")
    fixtures.trips(spark, sf_dir).select(
        "VendorID", "PULocationID", "DOLocationID", "trip_distance").write.csv(path, header=True)
    subset = read_columns(spark, path, ["PULocationID", "trip_distance"])
    return subset.withColumn("trip_distance", F.col("trip_distance").cast("double"))


@query("SELECT * FROM events")
def json_roundtrip(spark, sf_dir):
    """All columns, times to the microsecond."""
    path = shared_dir(spark, "events") + ".json"
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    events = fixtures.table(spark, sf_dir, "events")
    write_json_lines(events, path, **micros)
    return comparable(read_file(spark, path, schema=events.schema, **micros))


@query(f"WITH {TRIPS} SELECT {ALL_TRIP_COLUMNS} FROM trips")
def parquet_like_first(spark, sf_dir):
    """Two folders of Parquet files, under the schema of the first, loaded into a table."""
    paths = []
    trips = fixtures.trips(spark, sf_dir)
    for name in SERVICE:
        paths.append(shared_dir(spark, f"{name}-parquet"))
        write_parquet(trips.where(F.col("service_type") == name), paths[-1], files=4)
    table, location = _new_table(spark, "native")
    replace_table(read_parquet_like(spark, paths), table, location=location)
    return comparable(spark.table(table))


@query(f"""
WITH {TRIPS} SELECT {ALL_TRIP_COLUMNS} FROM trips
WHERE service_type = 'green' AND payment_type < 4""")
def replace_partitioned_table(spark, sf_dir):
    """A partitioned table replaced by fewer partitions: the others are gone."""
    table, location = _new_table(spark, "replaced")
    trips = fixtures.trips(spark, sf_dir)
    few = trips.where((F.col("service_type") == "green") & (F.col("payment_type") < 4))
    for rows in (trips, few):
        replace_table(rows, table, partition_by=["service_type"], location=location)
    return comparable(spark.table(table))


@query(f"WITH {TRIPS} SELECT {ALL_TRIP_COLUMNS} FROM trips WHERE service_type = 'yellow'")
def truncate_then_append(spark, sf_dir):
    """A staging table emptied before each load."""
    table, _ = _new_table(spark, "staging")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    ensure_table(spark, table, TRIP_DATA)
    trips = fixtures.trips(spark, sf_dir)
    for name in ("green", "yellow"):
        truncate_table(spark, table)
        append_table(trips.where(F.col("service_type") == name), table)
    return comparable(_whole_numbers_as_int(spark.table(table)))


FILE_TABLES = ("customer", "nation", "part", "region", "supplier")


@query(" UNION ALL BY NAME ".join(
    f"SELECT '{t}' AS table_name, COLUMNS(*)::VARCHAR FROM {t}" for t in FILE_TABLES))
def files_to_tables(spark, sf_dir):
    """CSV files found by a glob and loaded into one table each; all their values."""
    source, stored = shared_dir(spark, "landed"), shared_dir(spark, "stored")
    for name in FILE_TABLES:
        fixtures.table(spark, sf_dir, name).write.csv(f"{source}/{name}.csv", header=True)
    loaded = load_files_to_tables(
        spark, f"{source}/*.csv", lambda df, table: df.write.parquet(f"{stored}/{table}"))
    frames = [spark.read.parquet(f"{stored}/{t}").withColumn("table_name", F.lit(t)) for t in loaded]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


@query("""
WITH e AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS n FROM events),
batches AS (SELECT *, CASE WHEN event_id % 10 = 3 THEN 3 WHEN ts < (SELECT ts FROM e WHERE n =
  (SELECT count(*) // 2 FROM e)) THEN 1 ELSE 2 END AS batch FROM events),
seen AS (SELECT max(ts) - INTERVAL 5 SECOND AS mark FROM batches WHERE batch < 3),
kept AS (SELECT b.* FROM batches b, seen WHERE batch < 3 OR
  time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE > mark)
SELECT user_id, event_type, count(*) AS event_count, min(event_id) AS first_id,
  max(event_id) AS last_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end
FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start FROM kept)
GROUP BY user_id, event_type, window_start
HAVING window_start + INTERVAL 5 MINUTE <= (SELECT max(ts) - INTERVAL 5 SECOND FROM batches)""")
def stream_late_rows(spark, sf_dir):
    """Three batches; a tenth of the rows comes in the last, behind the watermark, and is dropped."""
    events = fixtures.table(spark, sf_dir, "events")
    half = time_at(events, "ts", events.count() // 2 - 1)
    late = F.col("event_id") % 10 == 3
    early = F.col("ts") < F.lit(half)
    out = shared_dir(spark, "stream-late")
    for rows in (events.where(~late & early), events.where(~late & ~early), events.where(late)):
        rows.write.mode("append").parquet(f"{out}/in")
        stream = replay_files(spark, f"{out}/in", events.schema)
        counts = stream_zone_pair_counts(stream, event_time="ts", keys=EVENT_KEYS,
                                         bound="event_id", **EVENT_NAMES)
        start_append(counts, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return comparable(spark.read.parquet(f"{out}/rows"))
