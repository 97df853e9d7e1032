"""Streams written by batch, sessions, bitmaps, footers, and reports kept up by day."""

from __future__ import annotations

import os
from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import plan_of, values
from tests.test_sources import GREEN_ROW, write_csv
from tripflow import fixtures, queries
from tripflow.operators import (
    count_bitmaps,
    distinct_bitmaps,
    merged_bitmaps,
    monthly_revenue,
    session_counts,
    session_counts_by_span,
)
from tripflow.plans import load_arrivals, refresh_daily_sums, report_from_sums
from tripflow.queries import ORACLES, stream_late_rows
from tripflow.schema import GREEN_FILE, TRIP_DATA
from tripflow.sinks import append_table, ensure_table
from tripflow.sources import footer_counts, footer_marks, from_footers, with_micros
from tripflow.sources.footers import footer_frame
from tripflow.streaming import (
    fold_updates,
    read_sorted,
    read_updated,
    replay_files,
    start_sorted,
    start_table,
    start_update,
    stream_zone_pair_counts,
)

EVENT = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("ts", T.TimestampNTZType()),
                      T.StructField("id", T.LongType())])


def at(minute: float) -> datetime:
    return datetime(2024, 1, 1) + timedelta(minutes=minute)


def forget_last_commit(checkpoint: str) -> None:
    """As after a crash between writing a batch and noting it."""
    commits = sorted((int(f), f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit())
    os.remove(f"{checkpoint}/commits/{commits[-1][1]}")
    crc = f"{checkpoint}/commits/.{commits[-1][1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)


def land(spark, folder: str, *rows) -> None:
    spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(folder)


def test_rows_are_taken_as_they_arrive(spark, tmp_path):
    """Late rows, a rerun, a crash before the commit, two sources in one table."""
    place, name = str(tmp_path / "t"), "arrived"

    def run(source="a"):
        stream = replay_files(spark, str(tmp_path / source), EVENT)
        start_table(stream, name, str(tmp_path / f"checkpoint-{source}"), source=source,
                    location=place).awaitTermination()

    land(spark, str(tmp_path / "a"), (1, at(100), 1), (1, at(200), 2))
    run()
    land(spark, str(tmp_path / "a"), (1, at(5), 3))
    run()
    run()
    assert values(spark.table(name).select("id")) == [(1,), (2,), (3,)]
    forget_last_commit(str(tmp_path / "checkpoint-a"))
    run()
    assert values(spark.table(name).select("id")) == [(1,), (2,), (3,)]
    land(spark, str(tmp_path / "b"), (2, at(1), 9))
    run("b")
    assert values(spark.table(name).select("id", "load_source")) == [(1, "a"), (2, "a"), (3, "a"), (9, "b")]
    # A new catalog finds what earlier batches brought.
    spark.sql(f"DROP TABLE {name}")
    land(spark, str(tmp_path / "a"), (1, None, 4))
    run()
    assert values(spark.table(name).select("id")) == [(1,), (2,), (3,), (4,), (9,)]
    spark.sql(f"DROP TABLE {name}")


def test_old_files_that_arrive_late(spark, tmp_path):
    """A file much older than the newest is taken when it comes."""
    folder = tmp_path / "landed"
    folder.mkdir()
    write_csv(folder / "green_2.csv.gz", GREEN_FILE, GREEN_ROW)
    load_arrivals(spark, str(folder), "green", "old_arrivals", str(tmp_path / "c"),
                  location=str(tmp_path / "t")).awaitTermination()
    old = write_csv(folder / "green_1.csv.gz", GREEN_FILE, GREEN_ROW, GREEN_ROW)
    os.utime(old, (1e9, 1e9))
    for _ in range(2):
        load_arrivals(spark, str(folder), "green", "old_arrivals", str(tmp_path / "c"),
                      location=str(tmp_path / "t")).awaitTermination()
    assert spark.table("old_arrivals").count() == 3
    assert spark.table("old_arrivals").columns[:-2] == TRIP_DATA.fieldNames()
    spark.sql("DROP TABLE old_arrivals")


def test_every_row_is_kept_late_or_undecodable(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run():
        start_sorted(replay_files(spark, folder, EVENT), out, checkpoint, event_time="ts",
                     decodable=F.col("k") > 0).awaitTermination()

    land(spark, folder, (1, at(1), 1), (1, at(20), 2), (1, None, 3), (0, at(500), 4), (None, at(1), 5))
    run()
    # The watermark is 19:55: windows that end by then are closed, the one up to 20:00 is not.
    land(spark, folder, (1, at(14.9), 6), (1, at(15), 7), (1, at(19.9), 8), (1, at(20), 9), (1, at(40), 10))
    run()
    land(spark, folder, (1, at(34.9), 11), (1, at(35), 12), (0, at(1), 13))
    run()
    wanted = [("kept", i) for i in (1, 2, 7, 8, 9, 10, 12)] + [("late", i) for i in (6, 11)] + [
        ("undecodable", i) for i in (3, 4, 5, 13)]
    assert values(read_sorted(spark, out).select("kind", "id")) == sorted(wanted, key=repr)
    forget_last_commit(checkpoint)
    run()
    assert values(read_sorted(spark, out).select("kind", "id")) == sorted(wanted, key=repr)


def test_late_rows_with_several_events_in_a_window(spark, tmp_path):
    """The query's SQL against the stream where windows hold more than one event."""
    rows = [(i, at(i * 1.3), i % 2, "x", 1.0, "{}") for i in range(200)]
    events = spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    found = stream_late_rows(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    wanted = con.execute(ORACLES["stream_late_rows"]).df()
    names = sorted(wanted.columns)
    got = sorted(map(tuple, found.toPandas()[names].itertuples(index=False)))
    assert got == sorted(map(tuple, wanted[names].itertuples(index=False)))
    assert max(wanted["event_count"]) > 1 and wanted["event_count"].sum() < 200


def test_updated_windows(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    keys = ["k", "window_start"]

    def run():
        counts = stream_zone_pair_counts(replay_files(spark, folder, EVENT), "1 day", event_time="ts",
                                         keys=["k"], bound="id", with_bounds=True)
        start_update(counts, out, checkpoint).awaitTermination()

    def result():
        return values(read_updated(spark, out, keys).select("k", "trip_count", "start_time", "end_time"))

    land(spark, folder, (1, at(1), 1), (2, at(1), 2), (1, at(7), 3))
    run()
    assert result() == [(1, 1, 1, 1), (1, 1, 3, 3), (2, 1, 2, 2)]
    land(spark, folder, (1, at(2), 4))
    run()
    wanted = [(1, 1, 3, 3), (1, 2, 1, 4), (2, 1, 2, 2)]
    assert result() == wanted
    forget_last_commit(checkpoint)
    run()
    assert result() == wanted
    os.makedirs(f"{out}/updates/batch=99")
    assert result() == wanted
    # Closing windows may have taken a batch without rows.
    assert fold_updates(spark, out, keys) >= 2 and fold_updates(spark, out, keys) == 0
    assert result() == wanted
    land(spark, folder, (2, at(3), 5))
    run()
    assert result() == [(1, 1, 3, 3), (1, 2, 1, 4), (2, 2, 2, 5)]


def test_sessions_by_span_and_across(spark):
    """Gaps of just the length, sessions over span ends, ties, nulls, a hot key."""
    minutes = [0, 5, 10.001, 58, 62, 66.5, 71.5, 119.9, 120, 120, 240, 1439, 1441]
    rows = [(k, at(m + k), i) for k in (1, 2) for i, m in enumerate(minutes)]
    rows += [(None, at(3), 50), (1, None, 51)] + [(7, at(i), i) for i in range(0, 300, 3)]
    df = spark.createDataFrame(rows, EVENT)
    names = ["k", "trip_count", "start_time", "end_time", "session_start", "session_end"]
    plain = values(session_counts(df, "ts", ["k"], "id").select(*names))
    assert values(session_counts_by_span(df, "ts", ["k"], "id").select(*names)) == plain
    wanted, last = [], {}
    for k, ts, i in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] or 0, r[1])):
        if k in last and ts - last[k][4] <= timedelta(minutes=5):
            own = last[k]
        else:
            own = last[k] = [0, i, i, ts, ts]
            wanted.append((k, own))
        own[0], own[1], own[2], own[4] = own[0] + 1, min(own[1], i), max(own[2], i), ts
    assert plain == sorted(((k, n, a, b, s, e + timedelta(minutes=5)) for k, (n, a, b, s, e) in wanted), key=repr)


def test_bitmaps_merge_exactly(spark):
    rows = [(d, n) for d in range(5) for n in (d, 7, 40_000 + d % 2, 1 << 40)] + [(9, None), (9, -3), (9, 0)]
    df = spark.createDataFrame(rows, "day int, zone long")
    days = distinct_bitmaps(df, F.col("zone"), ["day"])
    exact = {r[0]: r[1] for r in df.groupBy("day").agg(F.count_distinct("zone")).collect()}
    assert dict(map(tuple, count_bitmaps(days, ["day"]).collect())) == exact
    assert count_bitmaps(days, []).first()[0] == df.agg(F.count_distinct("zone")).first()[0]
    part = count_bitmaps(merged_bitmaps(days.where("day IN (1, 3)"), []), []).first()[0]
    assert part == df.where("day IN (1, 3)").agg(F.count_distinct("zone")).first()[0]
    assert count_bitmaps(days.limit(0), []).first()[0] == 0


def test_aggregates_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    trips = spark.range(900).select(
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("pickup_datetime"),
        F.when(F.col("id") < 300, "green").otherwise("yellow").alias("service_type"))
    with_micros(trips, "pickup_datetime").write.partitionBy("service_type").parquet(path)
    plan = plan_of(footer_frame(spark, path).groupBy("service_type").agg(
        F.count(F.lit(1)), F.max("pickup_datetime_micros")))
    assert "PushedAggregation: [COUNT(*), MAX(pickup_datetime_micros)]" in plan
    assert values(footer_counts(spark, path)) == [(900,)]
    assert values(footer_counts(spark, path, ["service_type"])) == [("green", 300), ("yellow", 600)]
    assert footer_marks(spark, path, ["green", "yellow", "fhv"]) == {
        "green": "1970-01-01 00:04:59", "yellow": "1970-01-01 00:14:59", "fhv": "1970-01-01 00:00:00"}
    # The session's own settings are as before.
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_files_without_statistics(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"v": [3, 1, 2]}), tmp_path / "a.parquet", write_statistics=False)
    rows = from_footers(spark, str(tmp_path), lambda df: df.agg(F.max("v").alias("v")))
    assert [tuple(r) for r in rows] == [(3,)]
    with pytest.raises(Exception, match="nothing"):
        from_footers(spark, str(tmp_path), lambda df: df.agg(F.max("nothing")))


def test_daily_sums_read_changed_days_only(spark, tmp_path):
    sums = str(tmp_path / "sums")

    def trips(days, fare):
        kinds = {f.name: f.dataType for f in TRIP_DATA.fields}
        fixed = {"service_type": F.lit("green"), "PULocationID": (F.col("id") % 3).cast("string"),
                 "passenger_count": F.col("id") % 4, "trip_distance": F.col("id") / 7, "fare_amount": F.lit(fare)}
        frames = [spark.range(20).select(*[
            fixed[c].cast(k).alias(c) if c in fixed else F.lit(d).cast(k).alias(c) if c == "pickup_datetime"
            else F.lit(None).cast(k).alias(c) for c, k in kinds.items()]) for d in days]
        result = frames[0]
        for f in frames[1:]:
            result = result.unionByName(f)
        return result

    ensure_table(spark, "daily", TRIP_DATA, day_of="pickup_datetime", location=str(tmp_path / "t"))
    append_table(trips(["2024-01-30 10:00:00", "2024-01-31 10:00:00", "2024-02-01 10:00:00"], 1), "daily",
                 day_of="pickup_datetime")
    refresh_daily_sums(spark.table("daily"), sums)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "sums").glob("*/*.parquet")}
    append_table(trips(["2024-01-31 12:00:00"], 5), "daily", day_of="pickup_datetime")
    changed = [date(2024, 1, 31), date(2024, 3, 1)]
    refresh_daily_sums(spark.table("daily"), sums, changed)
    same = [p for p in before if p.exists() and p.stat().st_mtime_ns == before[p]]
    assert len(before) == 3 and len(same) == 2 and not any("01-31" in str(p) for p in same)
    stored = spark.read.schema("service_type string, revenue_zone string, report_day date").parquet(sums)
    assert stored.select("report_day").distinct().count() == 3
    got = report_from_sums(spark.read.parquet(sums))
    wanted = monthly_revenue(spark.table("daily"), "2024-01-01", "2024-04-01", half_open=True)
    assert sorted(values(got.select(*wanted.columns))) == sorted(values(wanted))
    january = report_from_sums(spark.read.parquet(sums), "2024-01-01", "2024-02-01")
    assert {r[0] for r in january.select(F.month("revenue_month")).collect()} == {1}
    # A day that lost its rows loses its sums.
    spark.sql("ALTER TABLE daily DROP PARTITION (pickup_date = '2024-01-30')")
    refresh_daily_sums(spark.table("daily"), sums, [date(2024, 1, 30)])
    assert spark.read.parquet(sums).select("report_day").distinct().count() == 2
    spark.sql("DROP TABLE daily")


def test_incremental_load_by_day_joins_orders_once(spark, tmp_path, monkeypatch):
    days = ["1998-01-01", "1999-06-01", "1999-06-01", "2000-06-01"]
    spark.createDataFrame(
        [(i, i + 1, 10.0, d) for i, d in enumerate(days)], "o_orderkey long, o_custkey long, o_totalprice double, d string",
    ).selectExpr("* except (d)", "cast(d as timestamp_ntz) o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(o, 5, 7, n, 2.0, 3.0, 0.1, 0.2, "R", status) for o in range(4) for n, status in ((1, "O"), (2, "F"))]
    spark.createDataFrame(
        lines + lines[:1], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
    ).selectExpr("*", "timestamp_ntz'2001-01-01 00:00:00' l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    read = []
    table = fixtures.table
    monkeypatch.setattr(fixtures, "table", lambda s, d, name: read.append(name) or table(s, d, name))
    found = queries.QUERIES["incremental_load_by_day"](spark, str(tmp_path))
    # Loaded are green to 1999 and yellow to 2000; the rest comes by the marks.
    assert sorted((r.pickup_date.year, r.service_type) for r in found.collect()) == sorted(
        [(1998, "yellow")] * 2 + [(1998, "green")] + [(1999, s) for s in ("green", "yellow")] * 2
        + [(2000, s) for s in ("green", "yellow")])
    assert read.count("orders") == 1


def test_arrival_load_joins_orders_once(spark, tmp_path, monkeypatch):
    spark.createDataFrame(
        [(o, o + 1, 10.0) for o in (0, 1, 1)], "o_orderkey long, o_custkey long, o_totalprice double",
    ).selectExpr("*", "timestamp_ntz'1998-01-01 00:00:00' o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    # No yellow row is of the third round. Rows without passengers, or of a negative rest, are of none.
    lines = [(0, 5, 7, 1, q, 3.0, 0.1, 0.2, "R", status)
             for q, status in ((3.0, "O"), (4.0, "O"), (3.0, "F"), (4.0, "F"), (5.0, "F"), (None, "F"), (-1.0, "O"))]
    spark.createDataFrame(
        lines + [(1, *lines[0][1:])], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string",
    ).selectExpr("*", "timestamp_ntz'2001-01-01 00:00:00' l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    read = []
    table = fixtures.table
    monkeypatch.setattr(fixtures, "table", lambda s, d, name: read.append(name) or table(s, d, name))
    found = queries.QUERIES["arrival_load"](spark, str(tmp_path))
    assert values(found.select("DOLocationID", "service_type", "passenger_count", "fare_amount")) == sorted(
        [("1", "yellow", 3, 3.0), ("1", "yellow", 4, 3.0), *[("1", "green", q, 3.0) for q in (3, 4, 5)],
         *[("2", "yellow", 3, 3.0)] * 2], key=repr)
    assert read.count("orders") == 1
