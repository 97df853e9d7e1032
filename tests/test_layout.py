"""Tables in buckets, and compaction of day partitions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import executed_plan_of, values
from tripflow.operators.merge import insert_only_bucketed, new_ids
from tripflow.plans import merge_into_table
from tripflow.schema import SERVICE
from tripflow.sinks import append_table, ensure_table
from tripflow.sinks.compaction import compact_days, day_files, delete_replaced


def raw_rows(spark, first, last):
    green = SERVICE["green"]
    rows = spark.range(first, last).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in (green.pickup, "VendorID")
          else F.timestamp_seconds(F.col("id") * 7200).cast(f.dataType).alias(f.name)
          if f.name == green.pickup else F.col("id").cast(f.dataType).alias(f.name)
          for f in green.file_schema.fields])
    return rows


def test_merge_into_buckets(spark, tmp_path):
    place = str(tmp_path / "t")
    for first, last in ((0, 50), (30, 90), (0, 90), (20, 30)):
        merge_into_table(spark, raw_rows(spark, first, last), "in_buckets", "green", f"{first}", buckets=4,
                         location=place)
    table = spark.table("in_buckets")
    assert values(table.groupBy("filename").count()) == [("0", 50), ("30", 40)]
    assert table.select("unique_row_id").distinct().count() == 90
    # A new catalog finds the buckets again by the table's definition.
    spark.sql("DROP TABLE in_buckets")
    merge_into_table(spark, raw_rows(spark, 80, 100), "in_buckets", "green", "z", buckets=4, location=place)
    assert spark.table("in_buckets").count() == 100
    with pytest.raises(ValueError, match="layout"):
        merge_into_table(spark, raw_rows(spark, 0, 1), "in_buckets", "green", "z", by_day=False)
    spark.sql("DROP TABLE in_buckets")


def test_the_target_in_buckets_is_not_moved(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("v", T.LongType())])
    for buckets in (4, 16):
        name = f"still_{buckets}"
        ensure_table(spark, name, schema, location=str(tmp_path / name), bucket_by=("id", buckets))
        for n in (0, 1):
            append_table(spark.range(n * 500, n * 500 + 500).select(F.md5(F.col("id").cast("string")).alias("id"),
                                                    F.col("id").alias("v")), name, bucket_by=("id", buckets))
        # A third of the staging rows share one id.
        staging = spark.range(900, 1200).select(F.md5(F.when(F.col("id") % 3 == 0, -1).otherwise(
            F.col("id")).cast("string")).alias("id"), F.col("id").alias("v"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        try:
            new = insert_only_bucketed(staging, spark.table(name), "id")
            plan = executed_plan_of(new_ids(staging, spark.table(name), "id"))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert new.count() == len({v for v in range(900, 1200) if v % 3 == 0 or v >= 1000})
        final = plan.split("Initial Plan")[0]
        lines = final.splitlines()
        scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
        # Up to the sort for the join nothing moves the target's ids.
        sort = max(i for i in range(scan) if "Sort [" in lines[i])
        assert scan - sort <= 4 and "LeftAnti" in final
        assert not any("Exchange" in line or "ShuffleQueryStage" in line for line in lines[sort:scan]), final
        spark.sql(f"DROP TABLE {name}")


def by_day(spark, name, place, appends=4):
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.LongType())])
    ensure_table(spark, name, schema, day_of="ts", day_col="day", location=place)
    for n in range(appends):
        rows = spark.range(n * 90, n * 90 + 90).select(
            F.date_add(F.lit("2024-03-01"), (F.col("id") % 9).cast("int")).cast("timestamp_ntz").alias("ts"),
            F.col("id").alias("v"))
        append_table(rows, name, day_of="ts", day_col="day")


def test_compaction(spark, tmp_path):
    by_day(spark, "many_files", str(tmp_path / "t"))
    one_day = spark.range(1000, 1010).select(F.lit("2024-05-01").cast("timestamp_ntz").alias("ts"),
                                             F.col("id").alias("v"))
    append_table(one_day, "many_files", day_of="ts", day_col="day")
    table = spark.table("many_files")
    rows, before = values(table), day_files(table, "day").count()
    assert before >= 37
    done = compact_days(spark, "many_files", "day", ["v"])
    assert len(done) == 9 and all(d.files == 1 for d in done)
    table = spark.table("many_files")
    assert values(table) == rows
    assert day_files(table, "day").count() == 10
    assert compact_days(spark, "many_files", "day") == []
    delete_replaced(spark, done)
    assert values(spark.table("many_files")) == rows
    # Later rows join the days, which are due again.
    append_table(one_day.withColumn("ts", F.lit("2024-03-02").cast("timestamp_ntz")), "many_files",
                 day_of="ts", day_col="day")
    assert spark.table("many_files").count() == len(rows) + 10
    assert [d.day.isoformat() for d in compact_days(spark, "many_files", "day")] == ["2024-03-02"]
    assert spark.table("many_files").count() == len(rows) + 10
    spark.sql("DROP TABLE many_files")


def test_a_large_day_gets_the_files_its_bytes_need(spark, tmp_path):
    by_day(spark, "large_day", str(tmp_path / "t"))
    sizes = {r["day"]: r["s"] for r in day_files(spark.table("large_day"), "day").groupBy("day").agg(
        F.sum("size").alias("s")).collect()}
    target = max(sizes.values()) // 2 + 1
    done = compact_days(spark, "large_day", "day", target_bytes=target)
    assert done and all(d.files == -(-sizes[d.day] // target) for d in done)
    assert spark.table("large_day").count() == 360
    spark.sql("DROP TABLE large_day")


def test_a_failed_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    by_day(spark, "failing_days", str(tmp_path / "t"), appends=2)
    rows, files = values(spark.table("failing_days")), values(day_files(spark.table("failing_days"), "day"))
    monkeypatch.setattr("tripflow.sinks.compaction.uuid.uuid4", lambda: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        compact_days(spark, "failing_days", "day")
    monkeypatch.undo()
    assert values(day_files(spark.table("failing_days"), "day")) == files
    assert len(compact_days(spark, "failing_days", "day")) == 9
    assert values(spark.table("failing_days")) == rows
    spark.sql("DROP TABLE failing_days")
