"""The jobs one after another, from landed files to the report."""

from __future__ import annotations

import gzip
import os
import subprocess
import sys

import pyarrow.parquet as pq
import pytest

from tests.conftest import values
from tests.test_sources import GREEN_ROW, YELLOW_ROW, write_csv
from tripflow.__main__ import parser, run
from tripflow.schema import GREEN_FILE, YELLOW_FILE


@pytest.mark.parametrize("layout", [[], ["--by-day"]])
def test_from_files_to_report(spark, tmp_path, layout):
    later = YELLOW_ROW.replace("2024-01-01", "2024-02-01")
    january = write_csv(tmp_path / "yellow_tripdata_2024-01.csv.gz", YELLOW_FILE, YELLOW_ROW)
    february = write_csv(tmp_path / "yellow_tripdata_2024-02.csv.gz", YELLOW_FILE, YELLOW_ROW, later)
    green = write_csv(tmp_path / "green_tripdata_2024-01.csv.gz", GREEN_FILE, GREEN_ROW)

    def job(*argv):
        run(spark, parser().parse_args(["--root", str(tmp_path / "tables"), *argv]))

    job("merge", "--service", "yellow", "--path", january)
    job("merge", "--service", "green", "--path", green)
    job("increment", *layout)
    job("merge", "--service", "yellow", "--path", february)
    job("increment", "--partitions", "2")
    job("increment", "--lookback-days", "60")
    loaded = spark.table("yellow_tripdata").orderBy("tpep_pickup_datetime").collect()
    assert [r["filename"].rsplit("/", 1)[1] for r in loaded] == [
        "yellow_tripdata_2024-01.csv.gz", "yellow_tripdata_2024-02.csv.gz"]
    assert values(spark.table("trip_data").groupBy("service_type").count()) == [
        ("green", 1), ("yellow", 2)]
    job("report", "--start-time", "2024-01-01 00:00:00")
    assert spark.table("trip_data_report_2024").count() == 3
    job("report", "--start-time", "2024-02-01 00:00:00", "--end-time", "2024-02-29 23:59:59",
        "--dest-table", "february")
    row = spark.table("february").first()
    assert (row.revenue_zone, str(row.revenue_monthly_fare)) == ("01", "10.100000000")
    for table in ("yellow_tripdata", "green_tripdata", "trip_data", "trip_data_report_2024",
                  "february"):
        spark.sql(f"DROP TABLE {table}")


@pytest.mark.parametrize("layout", [[], ["--by-day"]])
def test_jobs_of_separate_processes(tmp_path, layout):
    """Each job starts with an empty catalog and finds the tables under the root."""
    january = write_csv(tmp_path / "yellow_tripdata_2024-01.csv.gz", YELLOW_FILE, YELLOW_ROW)
    later = YELLOW_ROW.replace("2024-01-01", "2024-02-01")
    february = write_csv(tmp_path / "yellow_tripdata_2024-02.csv.gz", YELLOW_FILE, YELLOW_ROW, later)
    root = tmp_path / "tables"

    def job(*argv):
        code = ("import sys; from tripflow.__main__ import main; main(sys.argv[1:])")
        done = subprocess.run(
            [sys.executable, "-c", code, "--root", str(root), *argv], capture_output=True, text=True,
            cwd=tmp_path, env=os.environ | {
                "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false "
                                       "--conf spark.sql.shuffle.partitions=2 pyspark-shell"})
        assert done.returncode == 0, done.stderr[-3000:]

    job("merge", "--service", "yellow", "--path", january)
    job("increment", "--services", "yellow", *layout)
    job("merge", "--service", "yellow", "--path", february)
    job("merge", "--service", "yellow", "--path", february)
    job("increment", "--services", "yellow")
    job("report", "--start-time", "2024-01-01 00:00:00")
    job("report", "--start-time", "2024-01-01 00:00:00")

    def rows(table):
        return pq.read_table(root / table).num_rows

    assert rows("yellow_tripdata") == 2 and rows("trip_data") == 2
    assert rows("trip_data_report_2024") == 2


def test_import_files(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Zone\n1,A\n")
    (tmp_path / "rates.csv.gz").write_bytes(gzip.compress(b"id\n5\n"))
    run(spark, parser().parse_args(
        ["--root", str(tmp_path / "tables"), "import-files", "--path", f"{tmp_path}/*.csv*"]))
    assert values(spark.table("zones")) == [("1", "A")]
    assert values(spark.table("rates")) == [("5",)]
    spark.sql("DROP TABLE zones")
    spark.sql("DROP TABLE rates")


def test_unknown_service_is_refused():
    with pytest.raises(SystemExit):
        parser().parse_args(["merge", "--service", "fhv", "--path", "x"])
