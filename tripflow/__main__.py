"""Jobs from the command line: ``spark-submit ... -m tripflow`` or ``python -m tripflow``."""

from __future__ import annotations

import argparse
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.report import report_table_name
from tripflow.plans import load_files_to_tables, load_increment, merge_into_table, write_report
from tripflow.schema import SERVICE
from tripflow.session import init_spark
from tripflow.sinks import register_stored, replace_table, write_jdbc
from tripflow.sources import read_trip_files

DAY = "pickup_date"


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="tripflow")
    main.add_argument("--root", help="folder under which each table's files lie, so that jobs "
                      "of other processes find them; the session's warehouse if left out")
    jobs = main.add_subparsers(dest="job", required=True)

    report = jobs.add_parser("report", help="write the monthly revenue of a time range")
    report.add_argument("--source-table", default="trip_data")
    report.add_argument("--start-time", required=True)
    report.add_argument("--end-time", help="inclusive; the start's whole year if left out")
    report.add_argument("--dest-table", help="trip_data_report_<year> if left out")

    merge = jobs.add_parser("merge", help="merge landed CSV files into a service's table")
    merge.add_argument("--service", required=True, choices=sorted(SERVICE))
    merge.add_argument("--path", required=True)
    merge.add_argument("--dest-table", help="<service>_tripdata if left out")

    increment = jobs.add_parser("increment", help="append new trips of all services to one table")
    increment.add_argument("--services", nargs="+", default=sorted(SERVICE))
    increment.add_argument("--dest-table", default="trip_data")
    increment.add_argument("--by-day", action="store_true",
                           help="partition a new table by pickup day")
    increment.add_argument("--partitions", type=int)
    increment.add_argument("--lookback-days", type=int)

    files = jobs.add_parser("import-files", help="load CSV files into one table each")
    files.add_argument("--path", required=True, help="glob")
    files.add_argument("--url", help="database; tables of the catalog if left out")
    files.add_argument("--user")
    files.add_argument("--password")
    files.add_argument("--driver")
    return main


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    root = (args.root or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")

    def place(table: str) -> str:
        return f"{root}/{table}"

    def stored(table: str) -> DataFrame:
        register_stored(spark, table, place(table))
        return spark.table(table)

    if args.job == "report":
        trips = stored(args.source_table)
        table = args.dest_table or report_table_name(args.start_time)
        write_report(trips, args.start_time, args.end_time, table=table, location=place(table),
                     day_col=DAY if DAY in trips.columns else None, keep=0)
    elif args.job == "merge":
        service = SERVICE[args.service]
        table = args.dest_table or service.table_name()
        merge_into_table(spark, read_trip_files(spark, args.path, service), table, service.name,
                         F.input_file_name(), location=place(table))
    elif args.job == "increment":
        raw = {s: stored(SERVICE[s].table_name()) for s in args.services if s in SERVICE}
        lookback = timedelta(days=args.lookback_days) if args.lookback_days else None
        known = register_stored(spark, args.dest_table, place(args.dest_table))
        by_day = DAY in spark.table(args.dest_table).columns if known else args.by_day
        load_increment(spark, raw, args.dest_table, by_day=by_day, partitions=args.partitions,
                       lookback=lookback, raw_day=DAY, location=place(args.dest_table))
    elif args.job == "import-files":
        login = {k: getattr(args, k) for k in ("user", "password", "driver") if getattr(args, k)}

        def to_database(df, table):
            write_jdbc(df, args.url, table, mode="overwrite", **login)

        def to_table(df, table):
            replace_table(df, table, location=place(table), keep=0)

        load_files_to_tables(spark, args.path, to_database if args.url else to_table)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = init_spark(f"tripflow {args.job}")
    run(spark, args)
    spark.stop()


if __name__ == "__main__":
    main()
