from __future__ import annotations

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL, executed_plan_of, values
from tripflow import fixtures
from tripflow.functions import concat_key
from tripflow.operators import days_of, insert_only, insert_only_stored, on_days, with_row_id
from tripflow.plans import merge_into_table, staged_merge
from tripflow.schema import SERVICE, database_types


def rows(spark, data):
    return spark.createDataFrame(data, "k string, v int")


def merged(new):
    return sorted((r["k"], r["v"]) for r in new.collect())


def test_duplicates_new_to_the_target_are_all_inserted(spark):
    raw, target = rows(spark, [("a", 1), ("a", 1), ("b", 2)]), rows(spark, [("b", 9)])
    held = with_row_id(target, ["k"], "old")
    assert merged(staged_merge(raw, held, ["k"], "new")) == [("a", 1), ("a", 1)]
    assert merged(staged_merge(raw, held, ["k"], "new", dedupe=True)) == [("a", 1)]


def test_matched_rows_leave_the_target_unchanged(spark):
    target = with_row_id(rows(spark, [("a", 1)]), ["k"], "old")
    assert merged(staged_merge(rows(spark, [("a", 2)]), target, ["k"], "new")) == []


def test_staging_columns_come_first(spark):
    new = staged_merge(rows(spark, [("a", 1)]), with_row_id(rows(spark, []), ["k"], "old"),
                       ["k"], "f.csv")
    assert new.columns == ["unique_row_id", "filename", "k", "v"]
    assert new.first()["filename"] == "f.csv"


def test_empty_staging(spark):
    target = with_row_id(rows(spark, [("a", 1)]), ["k"], "old")
    new = staged_merge(rows(spark, []), target, ["k"], "new")
    assert new.count() == 0


def test_unhashed_ids(spark):
    new = staged_merge(rows(spark, [("a", 1)]), with_row_id(rows(spark, []), ["k"], "old"),
                       ["k", "v"], "f.csv", make_key=concat_key)
    assert new.first()["unique_row_id"] == "a1"


@pytest.mark.parametrize("held", [True, False])
def test_a_hot_key_is_split_by_adaptive_execution(spark, held):
    """Three quarters of the rows share one id, which the target may hold many times."""
    keep = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keep}
    raw = spark.range(40000, numPartitions=8).select(
        F.when(F.col("id") % 4 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("int").alias("v"), F.sha2(F.col("id").cast("string"), 512).alias("more"))
    others = raw.where((F.col("v") % 8 == 0) & (F.col("k") != "hot"))
    hot = rows(spark, [("hot", 0)] * 50 if held else [])
    target = with_row_id(others.select("k", "v").unionByName(hot), ["k"], "old")
    new = insert_only(with_row_id(raw, ["k"], "new"), target)
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        plan = executed_plan_of(new)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan and "LeftAnti" in plan
    assert new.count() == 5000 + (0 if held else 30000)


@pytest.mark.parametrize("days", [3, 4500])
def test_a_key_without_the_day_is_compared_with_all_days(spark, days):
    """The same id on another day is the same row, however many days there are."""
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).cast("timestamp_ntz")
    raw = spark.range(days).select(F.col("id").cast("string").alias("k"), day.alias("t"))
    target = with_row_id(raw.select("k", (F.col("t") + F.expr("INTERVAL 20 YEARS")).alias("t")),
                         ["k"], "old")
    new = staged_merge(raw, target, ["k"], "new", time_col="t", target_day=F.to_date("t"))
    assert new.count() == 0
    other = with_row_id(raw.select("k", (F.col("t") + F.expr("INTERVAL 20 YEARS")).alias("t")),
                        ["k", "t"], "old")
    new = staged_merge(raw, other, ["k", "t"], "new", time_col="t", target_day=F.to_date("t"))
    assert new.count() == days


keys = st.one_of(st.none(), st.sampled_from("abc"))
pairs = st.lists(st.tuples(keys, st.integers(0, 3)), max_size=12)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs, pairs)
def test_merge_equals_brute_force(spark, staged, held):
    """Rows of keys the target lacks, each as often as staged; a null key is empty text."""
    known = {k or "" for k, _ in held}
    wanted = sorted((p for p in staged if (p[0] or "") not in known), key=repr)
    new = staged_merge(rows(spark, staged), with_row_id(rows(spark, held), ["k"], "old"), ["k"],
                       "new")
    assert values(new.select("k", "v")) == wanted


def test_null_keys_are_kept(spark):
    staging = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "id string, v int")
    target = spark.createDataFrame([("a",), (None,)], "id string")
    found = insert_only(staging, target, "id")
    assert values(found.select("v")) == [(1,), (3,)]


def test_days_include_rows_without_one(spark):
    staging = with_row_id(spark.createDataFrame(
        [("a", "2024-01-01"), ("b", None), ("c", "2024-01-01")], "k string, d string"), ["k"], "f")
    days = days_of(staging, F.col("d").cast("date"))
    assert sorted(map(str, days)) == ["2024-01-01", "None"]
    kept = on_days(staging, F.col("d").cast("date"), days)
    assert kept.count() == 3
    assert on_days(staging, F.col("d").cast("date"), []).count() == 0


def test_many_scattered_days(spark):
    every_other = [date(2024, 1, 1) + timedelta(days=2 * i) for i in range(3000)]
    df = spark.range(6000).select(F.expr("date_add(DATE'2024-01-01', CAST(id AS INT))").alias("d"))
    for days in (every_other, every_other[:10]):
        found = on_days(df, F.col("d"), [*days, None])
        assert [r["d"] for r in found.orderBy("d").collect()] == days


def test_merge_into_table_twice_adds_nothing(spark, tmp_path):
    for name in ("yellow", "green"):
        raw = fixtures.raw_trips(spark, SMALL, name)
        pickup = raw.columns[1]
        raw = raw.where(F.date_format(pickup, "yyyy-MM").isin("1997-12", "1998-01"))
        early = raw.where(F.col(pickup) < F.lit("1998-01-01").cast("timestamp_ntz"))
        # A row without a pickup time belongs to the null day.
        undated = raw.limit(1).withColumn(pickup, F.lit(None).cast("timestamp_ntz"))
        early = early.unionByName(undated)
        table = f"{name}_trips"
        location = str(tmp_path / name)
        merge_into_table(spark, early, table, name, "early.csv", location=location)
        merge_into_table(spark, early, table, name, "again.csv", location=location)
        assert spark.table(table).count() == early.count()
        merge_into_table(spark, raw, table, name, "all.csv", location=location)
        merge_into_table(spark, raw, table, name, "all.csv", location=location)
        assert spark.table(table).count() == raw.count() + 1
        days = spark.table(table).select(
            F.max(F.datediff("pickup_date", pickup)), F.count_if(F.col("pickup_date").isNull()))
        assert tuple(days.first()) == (0, 1)
        spark.sql(f"DROP TABLE {table}")


def test_no_join_is_left_for_days_the_target_lacks(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-02-01"), ("b", "2024-02-01")],
                               "k string, d string").withColumn("d", F.col("d").cast("date"))
    target = with_row_id(df.where("k = 'a'"), ["k", "d"], "old")
    options = {"time_col": "d", "target_day": F.col("d")}
    new = staged_merge(df.where("k = 'b'"), target, ["k", "d"], "new", **options)
    final = executed_plan_of(new).split("== Initial Plan ==")[0]
    assert new.count() == 2 and "Join" not in final
    both = staged_merge(df, target, ["k", "d"], "new", **options)
    assert values(both.select("k")) == [("b",), ("b",)]
    one = staged_merge(df, target, ["k", "d"], "new", dedupe=True, **options)
    assert values(one.select("k")) == [("b",)]


def test_database_like_table(spark):
    service = SERVICE["yellow"]
    raw = fixtures.raw_trips(spark, SMALL, "yellow")

    def load(source):
        merge_into_table(
            spark, raw, "yellow_database", "yellow", source, by_day=False,
            schema=database_types(service.table_schema), key_cols=service.text_key,
            make_key=concat_key)

    load("a.csv")
    load("b.csv")
    table = spark.table("yellow_database")
    assert table.schema["fare_amount"].dataType.simpleString() == "double"
    assert table.schema["tpep_pickup_datetime"].dataType.simpleString() == "timestamp_ntz"
    assert values(table.groupBy("filename").count()) == [("a.csv", raw.count())]
    row = table.first()
    assert row["unique_row_id"].startswith(f"{row['VendorID']}{row['tpep_pickup_datetime']}")
    spark.sql("DROP TABLE yellow_database")


def test_merge_reads_only_the_staging_days(spark, tmp_path):
    raw = fixtures.raw_trips(spark, SMALL, "green")
    raw = raw.where(F.date_format("lpep_pickup_datetime", "yyyy-MM") == "1998-01")
    merge_into_table(spark, raw, "green_pruned", "green", "a.csv", location=str(tmp_path / "t"))
    few = raw.where(F.to_date("lpep_pickup_datetime").isin("1998-01-05", "1998-01-06"))
    new = staged_merge(few, spark.table("green_pruned"), ["VendorID", "lpep_pickup_datetime",
                       "lpep_dropoff_datetime", "PULocationID", "DOLocationID"], "b.csv",
                       time_col="lpep_pickup_datetime", target_day=F.col("pickup_date"))
    plan = executed_plan_of(new)
    filters = [f.split("]")[0] for f in plan.split("PartitionFilters: [")[1:]]
    assert any("pickup_date" in f and "1998-01-05" in f and "1998-01-06" in f for f in filters)
    assert new.count() == 0
    spark.sql("DROP TABLE green_pruned")


@pytest.mark.parametrize("layout", [{}, {"by_day": False}, {"buckets": 3}])
def test_a_merge_moves_ids_not_rows(spark, tmp_path, layout, monkeypatch):
    """An empty table takes rows as they come; later only rows of days it holds are compared."""
    from tripflow.operators import merge
    from tripflow.plans import jobs

    kept = []

    def stored(df, label, store=merge.stored):
        kept.append((label, store(df, label)))
        return kept[-1][1]

    monkeypatch.setattr(merge, "stored", stored)
    monkeypatch.setattr(jobs, "stored", stored)
    raw = fixtures.raw_trips(spark, SMALL, "green")
    raw = raw.where(F.date_format("lpep_pickup_datetime", "yyyy-MM") == "1998-01")
    raw = raw.unionByName(raw.limit(1).withColumn("lpep_pickup_datetime", F.lit(None).cast("timestamp_ntz")))
    early = raw.where("lpep_pickup_datetime < '1998-01-20'")
    table = f"green_moved_{len(layout)}_{'buckets' in layout}"
    load = [dict(location=str(tmp_path / "t"), **layout)] * 2
    merge_into_table(spark, early.unionByName(early), table, "green", "early.csv", **load[0])
    assert not kept and spark.table(table).count() == 2 * early.count()
    late = early.limit(1).withColumn("PULocationID", F.lit("new"))
    merge_into_table(spark, raw.unionByName(late).unionByName(late), table, "green", "all.csv", **load[1])
    assert [label for label, _ in kept] == ["staging", "new-ids"]
    # Of a held day, twice; rows of other days and without one are not compared.
    assert kept[1][1].count() == 1
    assert spark.table(table).count() == early.count() + raw.count() + 2
    merge_into_table(spark, raw, table, "green", "again.csv", **load[1])
    assert spark.table(table).count() == early.count() + raw.count() + 2
    spark.sql(f"DROP TABLE {table}")


def test_stored_staging_keeps_rows_without_an_id(spark):
    staging = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), ("b", 3)], "id string, v int")
    target = spark.createDataFrame([("a",), (None,)], "id string")
    for found in (insert_only_stored(staging, target, "id"), insert_only(staging, target, "id")):
        assert values(found.select("v")) == [(1,), (3,), (3,)]
