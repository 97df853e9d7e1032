from __future__ import annotations

import json

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import plan_of, values
from tripflow.plans import load_files_to_tables
from tripflow.schema import TRIP_DATA
from tripflow.sinks import (
    append_table,
    encode_messages,
    ensure_table,
    finished_versions,
    register_stored,
    replace_table,
    truncate_table,
    write_day_partitioned,
    write_json_lines,
    write_parquet,
)
from tripflow.sources import time_range


def test_file_count(spark, tmp_path):
    write_parquet(spark.range(100), str(tmp_path / "p"), files=4)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 4


def test_json_lines_keep_nulls(spark, tmp_path):
    df = spark.createDataFrame([("x", None)], "a string, b int")
    write_json_lines(df, str(tmp_path / "j"))
    text = "".join(p.read_text() for p in (tmp_path / "j").glob("*.json"))
    assert json.loads(text) == {"a": "x", "b": None}


def test_messages_are_json_bytes(spark):
    df = spark.createDataFrame([(1, "é", 2), (None, "", 3)], "a int, b string, c int")
    found = [json.loads(r["value"].decode()) for r in encode_messages(df, ["a", "b"]).collect()]
    assert found == [{"a": 1, "b": "é"}, {"a": None, "b": ""}]


def test_ensure_keeps_an_existing_table(spark):
    ensure_table(spark, "kept", TRIP_DATA, day_of="pickup_datetime")
    spark.sql("INSERT INTO kept (VendorID) VALUES ('1')")
    ensure_table(spark, "kept", TRIP_DATA, day_of="pickup_datetime")
    table = spark.table("kept")
    assert table.count() == 1
    assert table.columns == [*TRIP_DATA.fieldNames(), "pickup_date"]
    assert table.schema["trip_distance"].dataType.simpleString() == "decimal(38,9)"
    truncate_table(spark, "kept")
    assert spark.table("kept").count() == 0
    spark.sql("DROP TABLE kept")


def test_replace_changes_schema_and_rows(spark):
    replace_table(spark.range(3), "swapped")
    replace_table(spark.createDataFrame([("x",)], "a string"), "swapped")
    assert values(spark.table("swapped")) == [("x",)]
    append_table(spark.createDataFrame([("y",)], "a string"), "swapped")
    assert spark.table("swapped").count() == 2
    spark.sql("DROP TABLE swapped")


def dated(spark):
    """Half of the rows fall on one day, in the order of their ids."""
    return spark.range(2000).select(
        "id", (F.col("id") % 5).alias("vendor"),
        (F.lit("2024-03-01").cast("timestamp_ntz") + F.make_dt_interval(
            F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 20).cast("int"))).alias("ts"))


def test_day_partitions_and_pruning(spark, tmp_path):
    path = str(tmp_path / "t")
    write_day_partitioned(dated(spark), path, "ts", "day", ["vendor"])
    stored = spark.read.parquet(path)
    assert stored.count() == 2000
    assert stored.where(F.to_date("ts") != F.col("day")).count() == 0
    found = time_range(stored, "ts", "2024-03-02", "2024-03-04", "day")
    plain = time_range(dated(spark), "ts", "2024-03-02", "2024-03-04")
    assert values(found.select("id")) == values(plain.select("id"))
    plan = plan_of(found)
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "cast(ts" not in plan and "GreaterThanOrEqual(ts,2024-03-02" in plan
    assert 0 < len(found.inputFiles()) <= len(stored.inputFiles())


def test_rows_of_a_file_are_ordered(spark, tmp_path):
    path = str(tmp_path / "t")
    write_day_partitioned(dated(spark), path, "ts", "day", ["vendor"])
    for file in (tmp_path / "t").glob("day=2024-03-01/*.parquet"):
        vendors = [r["vendor"] for r in spark.read.parquet(str(file)).collect()]
        assert vendors == sorted(vendors)


def test_a_large_day_is_written_by_several_tasks(spark, tmp_path):
    """A third of the rows fall on one day."""
    rows = spark.range(0, 60000, numPartitions=8).select(
        "id", F.md5(F.col("id").cast("string")).alias("text"),
        F.date_add(F.lit("2024-03-01"), F.when(F.col("id") % 3 == 0, 0).otherwise(
            F.col("id") % 30).cast("int")).cast("timestamp_ntz").alias("ts"))
    write_day_partitioned(rows, str(tmp_path / "t"), "ts", "day", ["id"], partitions=64)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t").glob("day=*")}
    # A third of 64 tasks for the large day, and a file more where a task holds two days.
    assert 18 <= files["day=2024-03-01"] <= 28 or max(files.values()) >= 18
    assert sum(files.values()) <= 64 + len(files)
    assert len(files) == 21
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60000


def test_a_partitioned_table_is_replaced_whole(spark, tmp_path):
    two = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    for rows in (two, two.where("p = 'a'")):
        replace_table(rows, "replaced_whole", ["p"], location=str(tmp_path / "t"))
    assert values(spark.table("replaced_whole")) == [(1, "a")]
    spark.sql("DROP TABLE replaced_whole")


def test_a_table_of_another_layout_is_refused(spark):
    plain = T.StructType([T.StructField("t", T.TimestampNTZType()), T.StructField("v", T.LongType())])
    ensure_table(spark, "laid_out", plain)
    ensure_table(spark, "laid_out", plain)
    with pytest.raises(ValueError, match="layout"):
        ensure_table(spark, "laid_out", plain, day_of="t")
    with pytest.raises(ValueError, match="layout"):
        ensure_table(spark, "laid_out", T.StructType([T.StructField("t", T.TimestampNTZType())]))
    spark.sql("DROP TABLE laid_out")


def test_files_of_one_name_and_odd_names(spark, tmp_path):
    (tmp_path / "green.2019.csv").write_text("id,x\n1,a\n2,b\n")
    (tmp_path / "green.2020.csv").write_text("id,y\n3,c\n")
    (tmp_path / "my file.csv").write_text("id\n7\n")
    spark.range(3).write.csv(str(tmp_path / "zones.csv"), header=True)
    got = {}

    def keep(df, name):
        got[name] = values(df)

    assert sorted(load_files_to_tables(spark, f"{tmp_path}/*.csv", keep)) == [
        "green", "my file", "zones"]
    assert got["green"] == [("1", "a", None), ("2", "b", None), ("3", None, "c")]
    assert got["my file"] == [("7",)] and len(got["zones"]) == 3


def test_one_table_per_file(spark, tmp_path):
    (tmp_path / "zones.v1.csv").write_text("LocationID,Zone\n1,A\n")
    (tmp_path / "rates.csv").write_text("id\n5\n6\n")
    paths = [str(p) for p in sorted(tmp_path.glob("*.csv"))]
    assert load_files_to_tables(spark, paths, replace_table) == ["rates", "zones"]
    assert values(spark.table("rates")) == [("5",), ("6",)]
    assert values(spark.table("zones")) == [("1", "A")]
    spark.sql("DROP TABLE rates")
    spark.sql("DROP TABLE zones")


def failing(spark):
    """Rows of which some cannot be computed."""
    return spark.range(0, 100, numPartitions=4).select(
        F.when(F.col("id") == 90, F.raise_error(F.lit("no such row"))).otherwise(F.col("id"))
        .cast("long").alias("id"))


@pytest.mark.parametrize("where", ["warehouse", "folder"])
def test_a_failed_replace_leaves_the_old_rows(spark, tmp_path, where):
    place = {"location": str(tmp_path / "t")} if where == "folder" else {}
    replace_table(spark.range(3), "kept_table", **place)
    with pytest.raises(Exception, match="no such row"):
        replace_table(failing(spark), "kept_table", **place)
    assert values(spark.table("kept_table")) == [(0,), (1,), (2,)]
    replace_table(spark.range(5), "kept_table", **place)
    assert spark.table("kept_table").count() == 5
    spark.sql("DROP TABLE kept_table")


@pytest.mark.parametrize("by", [[], ["p"]])
def test_a_table_is_replaced_by_its_own_rows(spark, tmp_path, by):
    place = str(tmp_path / "t")
    replace_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "v int, p string"), "own_rows", by,
                  location=place)
    before = spark.table("own_rows")
    replace_table(before.where("v > 1").select((F.col("v") * 10).alias("v"), "p"), "own_rows", by,
                  location=place)
    assert values(spark.table("own_rows")) == [(20, "b"), (30, "b")]
    # A reader that began before still has the rows of its version.
    assert values(before) == [(1, "a"), (2, "b"), (3, "b")]
    assert len(finished_versions(spark, place)) == 2
    replace_table(spark.table("own_rows").where("v < 30"), "own_rows", by, location=place, keep=0)
    assert values(spark.table("own_rows")) == [(20, "b")]
    assert len(finished_versions(spark, place)) == 1
    # An empty catalog finds the newest version again.
    spark.sql("DROP TABLE own_rows")
    assert register_stored(spark, "own_rows", place)
    assert values(spark.table("own_rows")) == [(20, "b")]
    spark.sql("DROP TABLE own_rows")


def test_unfinished_versions_are_passed_over(spark, tmp_path):
    place = str(tmp_path / "t")
    for n in (2, 3, 4):
        replace_table(spark.range(n), "versioned", location=place, keep=5)
    newest = finished_versions(spark, place)[-1].removeprefix("file:")
    (tmp_path / "t" / "v000000000009-broken").mkdir()
    assert finished_versions(spark, place)[-1].removeprefix("file:") == newest
    replace_table(spark.range(7), "versioned", location=place, keep=1)
    assert [f.rsplit("/v", 1)[1][:12] for f in finished_versions(spark, place)] == [
        "000000000003", "000000000010"]
    assert not (tmp_path / "t" / "v000000000009-broken").exists()
    assert spark.table("versioned").count() == 7
    spark.sql("DROP TABLE versioned")


def test_a_large_result_is_split_beyond_the_given_files(spark, tmp_path):
    """A task's share of it does not grow with it; the given number is the least."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 100_000, 1, 16)
    joining = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set(size, "20k")
    try:
        write_parquet(rows, str(tmp_path / "large"), files=2)
        write_parquet(rows.limit(10), str(tmp_path / "small"), files=2)
    finally:
        spark.conf.unset(size)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == joining
    assert len(list((tmp_path / "small").glob("*.parquet"))) == 2
    assert len(list((tmp_path / "large").glob("*.parquet"))) > 8
    assert spark.read.parquet(str(tmp_path / "large")).distinct().count() == 100_000
