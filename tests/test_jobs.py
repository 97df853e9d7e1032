from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, plan_of, values
from tripflow import fixtures
from tripflow.operators import (
    harmonize,
    high_water_mark,
    latest_marks,
    monthly_revenue,
    union_services,
)
from tripflow.plans import harmonize_new_rows, load_increment, project_with_defaults, write_report
from tripflow.schema import EPOCH, SERVICE, TRIP_DATA
from tripflow.sinks import append_table, ensure_table


def at(text):
    return datetime.fromisoformat(text)


def target(spark, rows):
    return spark.createDataFrame(
        [(s, t and at(t)) for s, t in rows], "service_type string, pickup_datetime timestamp_ntz")


def raw(spark, service, pickups):
    """Raw rows of a service; the vendor numbers them."""
    schema = SERVICE[service].file_schema
    rows = spark.createDataFrame(
        [(str(i), p and at(p)) for i, p in enumerate(pickups)], "VendorID string, t timestamp_ntz")
    given = {"VendorID": F.col("VendorID"), SERVICE[service].pickup: F.col("t").cast("timestamp"),
             SERVICE[service].dropoff: F.col("t").cast("timestamp")}
    return rows.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in schema.fields])


def test_marks(spark):
    loaded = target(spark, [("yellow", "2024-01-02T03:04:05.123456"), ("yellow", "2024-01-01"),
                            ("green", None), ("fhv", "2025-01-01")])
    assert latest_marks(loaded, ["yellow", "green"]) == {
        "yellow": "2024-01-02 03:04:05.123456", "green": EPOCH}
    assert latest_marks(loaded.limit(0), ["yellow"]) == {"yellow": EPOCH}
    assert latest_marks(None, ["yellow"]) == {"yellow": EPOCH}
    found = high_water_mark(loaded, ["green", "absent"])
    assert values(found) == [("absent", at("1970-01-01")), ("green", at("1970-01-01"))]


def test_marks_before_the_epoch_are_kept(spark):
    assert latest_marks(target(spark, [("yellow", "1960-01-01")]), ["yellow"]) == {
        "yellow": "1960-01-01 00:00:00"}


def test_failing_target_is_not_taken_for_an_empty_one(spark):
    with pytest.raises(Exception, match="(?i)pickup_datetime"):
        latest_marks(spark.createDataFrame([("yellow",)], "service_type string"), ["yellow"])


def test_marks_of_a_partitioned_target_read_one_day_per_service(spark, tmp_path):
    rows = [("yellow", "2024-01-01T10:00"), ("yellow", "2024-01-03T09:00"),
            ("yellow", "2024-01-03T11:00"), ("green", "2024-01-02T08:00"), ("green", None)]
    path = str(tmp_path / "t")
    (target(spark, rows).withColumn("day", F.to_date("pickup_datetime"))
     .write.partitionBy("service_type", "day").parquet(path))
    stored = spark.read.parquet(path)
    assert latest_marks(stored, ["yellow", "green", "fhv"], day_col="day") == {
        "yellow": "2024-01-03 11:00:00", "green": "2024-01-02 08:00:00", "fhv": EPOCH}
    last_days = stored.groupBy("service_type").agg(F.max("day"))
    assert "ReadSchema: struct<>" in plan_of(last_days)


def test_harmonized_columns(spark):
    for name, service in SERVICE.items():
        df = harmonize(raw(spark, name, ["2024-01-01"]), service)
        assert df.columns == TRIP_DATA.fieldNames()
        assert df.first()["service_type"] == name
        assert df.schema["pickup_datetime"].dataType.simpleString() == "timestamp"


def test_unknown_services_select_nothing(spark):
    frames = {"yellow": raw(spark, "yellow", ["2024-01-01"]), "fhv": spark.range(5)}
    assert union_services(frames).count() == 1
    none = union_services({"fhv": spark.range(5)})
    assert none.count() == 0 and none.columns == union_services(frames).columns
    assert harmonize_new_rows({"fhv": spark.range(5)}, none).count() == 0


def test_strictly_later_rows_are_taken(spark):
    new = harmonize_new_rows(
        {"yellow": raw(spark, "yellow", ["2024-01-01", "2024-01-01T00:00:00.000001", None]),
         "green": raw(spark, "green", ["1969-12-31", "1970-01-01", "1970-01-02"])},
        target(spark, [("yellow", "2024-01-01")]))
    assert values(new.select("service_type", "VendorID")) == [("green", "2"), ("yellow", "1")]


def test_marks_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, "yellow", ["2024-01-01", "2024-01-05"]).write.parquet(path)
    new = harmonize_new_rows({"yellow": spark.read.parquet(path)},
                             target(spark, [("yellow", "2024-01-02")]))
    assert "GreaterThan(tpep_pickup_datetime,2024-01-02" in plan_of(new)
    assert new.count() == 1


def test_increments_add_up(spark):
    first = {"yellow": raw(spark, "yellow", ["2024-01-01", "2024-01-02"]),
             "green": raw(spark, "green", ["2024-01-01"])}
    load_increment(spark, first, "increments")
    load_increment(spark, first, "increments")
    assert spark.table("increments").count() == 3
    more = {"yellow": raw(spark, "yellow", ["2024-01-01", "2024-01-02", "2024-01-03"])}
    load_increment(spark, more, "increments", partitions=2)
    assert values(spark.table("increments").groupBy("service_type").count()) == [
        ("green", 1), ("yellow", 3)]
    spark.sql("DROP TABLE increments")


def test_increments_by_day(spark):
    frames = {"yellow": raw(spark, "yellow", ["2024-01-01T05:00", "2024-01-02T06:00", None]),
              "green": raw(spark, "green", ["2024-01-01T07:00"])}
    load_increment(spark, frames, "by_day", by_day=True, partitions=3)
    table = spark.table("by_day")
    assert latest_marks(table, ["yellow", "green"], day_col="pickup_date") == latest_marks(
        table, ["yellow", "green"])
    more = {"yellow": raw(spark, "yellow", ["2024-01-02T06:00", "2024-01-02T06:00:01"])}
    load_increment(spark, more, "by_day", by_day=True)
    load_increment(spark, more, "by_day", by_day=True)
    assert values(spark.table("by_day").groupBy("pickup_date", "service_type").count().select(
        F.col("pickup_date").cast("string"), "service_type", "count")) == [
        ("2024-01-01", "green", 1), ("2024-01-01", "yellow", 1), ("2024-01-02", "yellow", 2)]
    spark.sql("DROP TABLE by_day")


def test_lookback_finds_late_rows_once(spark):
    ensure_table(spark, "late", TRIP_DATA)
    known = raw(spark, "yellow", ["2024-01-01", "2024-01-03"])
    append_table(harmonize(known, SERVICE["yellow"]), "late")
    seen = raw(spark, "yellow", ["2024-01-01", "2024-01-03", "2024-01-02", "2024-01-04", "2023-01-01"])
    table = spark.table("late")
    plain = harmonize_new_rows({"yellow": seen}, table)
    assert values(plain.select("VendorID")) == [("3",)]
    late = harmonize_new_rows({"yellow": seen}, table, lookback=timedelta(days=7))
    assert late.columns == TRIP_DATA.fieldNames()
    assert values(late.select("VendorID")) == [("2",), ("3",)]
    spark.sql("DROP TABLE late")


def edge_trips(spark):
    times = ["2024-01-01", "2024-12-31T23:59:59", "2024-12-31T23:59:59.5", "2025-01-01", None]
    df = harmonize(raw(spark, "green", times), SERVICE["green"])
    return df.withColumns({
        "fare_amount": F.lit("0.1").cast("decimal(38,9)"), "PULocationID": F.lit("7"),
        "trip_distance": F.when(F.col("VendorID") == "0", F.lit("2").cast("decimal(38,9)"))})


def test_last_second_of_the_year(spark):
    trips = edge_trips(spark)
    closed = monthly_revenue(trips, "2024-01-01 00:00:00", "2024-12-31 23:59:59")
    assert [str(r[0]) for r in closed.orderBy("revenue_month").select("revenue_monthly_fare")
            .collect()] == ["0.100000000", "0.100000000"]
    opened = monthly_revenue(trips, "2024-01-01", "2025-01-01", half_open=True)
    december = opened.where(F.month("revenue_month") == 12).first()
    assert str(december["revenue_monthly_fare"]) == "0.200000000"
    assert december["avg_monthly_trip_distance"] is None
    assert december["revenue_monthly_congestion_surcharge"] is None


def test_report_column_order(spark):
    assert monthly_revenue(edge_trips(spark), "2024-01-01", "2025-01-01").columns == [
        "revenue_zone", "revenue_month", "service_type", "revenue_monthly_fare",
        "revenue_monthly_extra", "revenue_monthly_mta_tax", "revenue_monthly_tip_amount",
        "revenue_monthly_tolls_amount", "revenue_monthly_improvement_surcharge",
        "revenue_monthly_total_amount", "revenue_monthly_congestion_surcharge",
        "avg_monthly_passenger_count", "avg_monthly_trip_distance"]


def test_report_is_replaced_not_appended(spark):
    trips = edge_trips(spark)
    assert write_report(trips, "2024-01-01") == "trip_data_report_2024"
    write_report(trips, datetime(2024, 1, 1))
    assert spark.table("trip_data_report_2024").count() == 2
    assert write_report(trips, "2025-01-01") == "trip_data_report_2025"
    assert spark.table("trip_data_report_2025").count() == 1
    spark.sql("DROP TABLE trip_data_report_2024")
    spark.sql("DROP TABLE trip_data_report_2025")


def test_months_add_up_to_the_total(spark):
    trips = fixtures.trips(spark, SMALL)
    monthly = monthly_revenue(trips, "1990-01-01", "2010-01-01", half_open=True)
    for measure, column in [("fare_amount", "revenue_monthly_fare"),
                            ("congestion_surcharge", "revenue_monthly_congestion_surcharge")]:
        assert monthly.agg(F.sum(column)).first()[0] == trips.agg(F.sum(measure)).first()[0]


def test_report_reads_the_days_of_its_range(spark, tmp_path):
    path = str(tmp_path / "t")
    (edge_trips(spark).withColumn("day", F.to_date("pickup_datetime"))
     .write.partitionBy("day").parquet(path))
    stored = spark.read.parquet(path)
    report = monthly_revenue(stored, "2024-12-01", "2025-01-01", half_open=True, day_col="day")
    assert "day#" in plan_of(report).split("PartitionFilters: [")[1].split("]")[0]
    plain = monthly_revenue(stored, "2024-12-01", "2025-01-01", half_open=True)
    assert values(report) == values(plain)


def test_report_combines_before_its_only_shuffle(spark):
    plan = plan_of(monthly_revenue(edge_trips(spark), "2024-01-01", "2025-01-01"))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_projection_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, '{"a": 1}'), (2, "broken")], "id int, d string")
    found = project_with_defaults(docs, F.try_parse_json("d"), ["a", "b"], keep=["id"])
    assert values(found) == [(1, "1", "N/A"), (2, None, None)]
    typed = project_with_defaults(docs, F.try_parse_json("d"), ["a"], as_text=False)
    assert typed.dtypes == [("a", "variant")]
