"""Time every query on one machine and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of local cores
and ``BENCH_QUERIES`` a comma-separated selection. Results are computed in full and
discarded. Under ``scan`` stand the files and bytes that a two-week range opens in
a table partitioned by day, against the whole table.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tripflow import fixtures  # noqa: E402
from tripflow.queries import QUERIES  # noqa: E402
from tripflow.session import init_spark, shared_dir  # noqa: E402
from tripflow.sinks import write_day_partitioned  # noqa: E402
from tripflow.sources import time_range  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def opened(df) -> dict:
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("b")).first()
    return {"files": row["n"], "bytes": row["b"]}


def scan_sizes(spark) -> dict:
    path = shared_dir(spark, "bench-days")
    write_day_partitioned(fixtures.trips(spark, SF_DIR), path, "dropoff_datetime", "dropoff_date",
                          ["VendorID"])
    table = spark.read.parquet(path)
    pruned = time_range(table, "dropoff_datetime", "1996-03-01", "1996-03-15", "dropoff_date")
    return {"pruned": opened(pruned), "whole": opened(table)}


def main() -> None:
    spark = init_spark("bench", {
        "spark.master": f"local[{CPUS}]",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": CPUS,
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    run(fixtures.trips(spark, SF_DIR))
    seconds = {}
    for name in names:
        begun = time.perf_counter()
        run(QUERIES[name](spark, SF_DIR))
        seconds[name] = round(time.perf_counter() - begun, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
    }
    if not os.environ.get("BENCH_QUERIES"):
        result["scan"] = scan_sizes(spark)
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
