from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from tripflow.operators import (
    count_distinct,
    count_rows,
    count_where,
    distinct_values,
    least_frequent_zones,
    longest_hours,
    mean_by_group,
    on_day,
    same_day,
    time_at,
    with_zone,
    zone_counts,
)


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(
        [(1, "1", datetime(2024, 10, 15, 23), datetime(2024, 10, 15, 23, 59), 0.0),
         (2, "1", datetime(2024, 10, 15, 23), datetime(2024, 10, 16), 5.0),
         (3, "2", datetime(2024, 10, 14), datetime(2024, 10, 14, 1), None),
         (None, None, datetime(2024, 10, 15), None, 0.0)],
        "PULocationID int, VendorID string, up timestamp_ntz, down timestamp_ntz, fare double")


@pytest.fixture(scope="module")
def zones(spark):
    return spark.createDataFrame([("01", "A"), ("2", "B"), ("3", "B"), ("x", "C"), (None, "D")],
                                 "LocationID string, Zone string")


def test_counts(trips):
    assert values(count_rows(trips)) == [(4,)]
    assert values(count_where(trips, F.col("fare") == 0)) == [(2,)]
    assert values(count_distinct(trips, "PULocationID")) == [(3,)]
    assert values(distinct_values(trips, "VendorID")) == [("1",), ("2",), (None,)]


def test_days(trips):
    assert values(count_where(trips, on_day("2024-10-15", "up", "down"))) == [(1,)]
    assert values(count_where(trips, on_day("2024-10-15", "up"))) == [(3,)]
    assert values(count_where(trips, same_day("up", "down"))) == [(2,)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_a_day_is_a_pushed_range(spark, tmp_path, kind):
    times = ["2024-10-14 23:59:59.999999", "2024-10-15 00:00:00", "2024-10-15 23:59:59.999999",
             "2024-10-16 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast(kind))
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = stored.where(on_day("2024-10-15", "t"))
    assert found.count() == stored.where("to_date(t) = DATE'2024-10-15'").count() == 2
    assert "GreaterThanOrEqual(t,2024-10-15" in plan_of(found)
    assert "LessThan(t,2024-10-16" in plan_of(found)


def test_longest(trips):
    assert values(longest_hours(trips, "up", "down")) == [(1.0,)]


def test_zone_ids_compare_as_numbers(trips, zones):
    assert values(with_zone(trips, zones).select("PULocationID", "Zone")) == [
        (1, "A"), (2, "B"), (3, "B")]


def test_zone_counts_equal_counting_joined_trips(spark, trips, zones):
    doubled = zones.union(spark.createDataFrame([("1", "Z"), ("1", "A")], zones.schema))
    joined = with_zone(trips, doubled).groupBy("Zone").count()
    assert values(zone_counts(trips, doubled)) == values(joined)


def test_hot_zone_is_counted_before_the_join(spark, zones):
    hot = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(
        F.col("id") % 100).cast("int").alias("PULocationID"))
    plan = plan_of(zone_counts(hot, zones))
    join = plan.index("Join")
    assert "partial_count" in plan[join:]
    joined = with_zone(hot, zones).groupBy("Zone").count()
    assert values(zone_counts(hot, zones)) == values(joined)


def test_ties_go_by_name(trips, zones):
    assert [tuple(r) for r in least_frequent_zones(trips, zones, 2).collect()] == [
        ("A", 1), ("B", 2)]
    assert "TakeOrderedAndProject" in plan_of(least_frequent_zones(trips, zones))


def test_means(spark):
    df = spark.createDataFrame([("a", 1.005), ("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", None)],
                               "g string, v double")
    assert [tuple(r) for r in mean_by_group(df, "g", "v").collect()] == [
        ("b", 3.0), ("c", 3.0), ("a", 1.0), ("d", None)]


def test_only_needed_columns_are_read(spark, trips, tmp_path):
    trips.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert "ReadSchema: struct<>" in plan_of(count_rows(stored))
    assert "ReadSchema: struct<PULocationID:int>" in plan_of(count_distinct(stored, "PULocationID"))
    assert "PushedFilters: [IsNotNull(fare), EqualTo(fare,0.0)]" in plan_of(
        count_where(stored, F.col("fare") == 0))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_at_a_position_as_in_a_sort(spark, kind):
    start = datetime(1969, 12, 31, 23, 59, 59)
    times = [None, None, *[start + timedelta(microseconds=m) for m in
             (0, 0, 1, 999_999, 1_000_000, 60_000_000, 60_000_001, 86_400_000_000, 86_400_000_001, 4 * 86_400_000_000)]]
    df = spark.createDataFrame([(t,) for t in times[::-1]], "t timestamp_ntz").select(F.col("t").cast(kind))
    wanted = [r["t"] for r in df.orderBy("t").collect()]
    assert [time_at(df, "t", k) for k in range(len(times))] == wanted
    for k in (-1, len(times)):
        with pytest.raises(ValueError):
            time_at(df, "t", k)


def test_time_at_sends_counts_not_rows_to_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    sent, collect = [], DataFrame.collect

    def counted(df):
        rows = collect(df)
        sent.append(len(rows))
        return rows

    monkeypatch.setattr(DataFrame, "collect", counted)
    df = spark.range(20000).select(F.timestamp_millis(F.col("id") * 60_000 % 3_600_000).alias("t"))
    assert time_at(df, "t", 9999).minute == 29
    assert sent and max(sent) <= 60
