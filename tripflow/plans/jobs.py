"""Jobs composed from the operators."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripflow.functions.json_fields import field_or_default
from tripflow.functions.keys import md5_key
from tripflow.operators.harmonize import harmonize, known_services, no_trips
from tripflow.operators.marks import latest_marks
from tripflow.operators.merge import (
    ROW_ID,
    days_of,
    insert_only,
    insert_only_stored,
    on_days,
    with_row_id,
)
from tripflow.operators.report import monthly_revenue, report_table_name, report_year
from tripflow.schema import SERVICE, TRIP_DATA
from tripflow.sinks.files import stored
from tripflow.sinks.tables import append_table, ensure_table, replace_table
from tripflow.sources.files import list_paths, read_csv_files, stream_trip_files
from tripflow.sources.tables import Moment, read_since
from tripflow.streaming.batches import start_table


def staged_merge(
    raw: DataFrame,
    target: DataFrame,
    key_cols: Sequence[Column | str],
    source_name: str | Column,
    *,
    make_key: Callable[..., Column] = md5_key,
    sep: str = "",
    dedupe: bool = False,
    time_col: str | None = None,
    target_day: Column | None = None,
) -> DataFrame:
    """Rows of ``raw``, with row id and file name, that the target lacks.

    Rows that share an id new to the target are all kept; ``dedupe`` keeps one of them.

    If ``time_col`` is among the key columns, rows of different days cannot be the same,
    short of ids that collide for want of a separator: given ``target_day`` as well,
    only target rows of the days found in ``raw`` are compared. The staging rows are then
    stored at once and the days read from there, so that ``raw`` is read once. Otherwise
    the whole target is compared.
    """
    staging = with_row_id(raw, key_cols, source_name, make_key=make_key, sep=sep)
    in_key = time_col in [c for c in key_cols if isinstance(c, str)]
    if in_key and target_day is not None:
        staging = stored(staging, "staging")
        target = on_days(target, target_day, days_of(staging, F.to_date(time_col)))
    new = insert_only(staging, target, ROW_ID)
    return new.dropDuplicates([ROW_ID]) if dedupe else new


def merge_into_table(
    spark: SparkSession,
    raw: DataFrame,
    table: str,
    service_name: str,
    source_name: str | Column,
    *,
    key_cols: Sequence[Column | str] | None = None,
    schema: StructType | None = None,
    by_day: bool = True,
    day_col: str = "pickup_date",
    location: str | None = None,
    partitions: int | None = None,
    buckets: int | None = None,
    **options,
) -> None:
    """Load a service's raw rows into its table, by pickup day, in buckets, or neither.

    An empty table takes the rows as they come. Otherwise they are stored with their ids, and
    ids alone are compared, by :func:`~tripflow.operators.merge.insert_only_stored`; if the
    pickup time is in the key, only those of days that the table holds.

    The table is created if need be. Running the job again, also after a failure,
    adds nothing twice. One writer per table at a time. The key defaults to the
    service's hashed key and the layout to its table's; a database-like table takes
    ``schema=database_types(service.table_schema)``, ``key_cols=service.text_key``,
    ``make_key=concat_key`` and ``by_day=False``.

    With ``buckets`` the table lies in so many buckets by row id instead, and merges move the
    staging rows alone, whatever their days. Their number is fixed when the table is made:
    take it such that a bucket's ids fit a task.
    """
    service = SERVICE[service_name]
    bucket_by = (ROW_ID, buckets) if buckets else None
    by_day = by_day and not buckets
    day_of = service.pickup if by_day else None
    ensure_table(spark, table, schema or service.table_schema, day_of=day_of, day_col=day_col,
                 location=location, bucket_by=bucket_by)
    key = key_cols or service.hashed_key
    target = spark.table(table)
    dedupe = options.pop("dedupe", False)
    new = with_row_id(raw, key, source_name, **options)
    if partitions or target.take(1):
        new = stored(new, "staging")
        days = {}
        if service.pickup in [c for c in key if isinstance(c, str)]:
            days = {"day": F.to_date(service.pickup),
                    "target_day": F.col(day_col) if by_day else F.to_date(service.pickup)}
        new = insert_only_stored(new, target, **days)
    append_table(new.dropDuplicates([ROW_ID]) if dedupe else new, table, day_of=day_of,
                 day_col=day_col, partitions=partitions, bucket_by=bucket_by)


HARMONIZED_KEY = ["service_type", "VendorID", "pickup_datetime", "dropoff_datetime",
                  "PULocationID", "DOLocationID"]


def harmonize_new_rows(
    raw_by_service: Mapping[str, DataFrame],
    target: DataFrame | None,
    *,
    marks: Mapping[str, str] | None = None,
    lookback: timedelta | None = None,
    target_day: str | None = None,
    raw_day: str | None = None,
) -> DataFrame:
    """Harmonised rows picked up after what the target holds of their service.

    Rows at or before the mark are missed by this rule. With ``lookback`` that span
    before the mark is read again and compared with the target by row id, so late
    rows are found and known rows are not repeated. ``raw_day`` names the day column
    of raw tables that have it. Without a known service there are no rows.
    """
    known = known_services(raw_by_service)
    if not known:
        return no_trips(raw_by_service)
    if marks is None:
        marks = latest_marks(target, list(known), day_col=target_day)
    if lookback:
        marks = {s: str(datetime.fromisoformat(m) - lookback) for s, m in marks.items()}
    new = reduce(DataFrame.unionByName, [
        harmonize(read_since(raw, SERVICE[s].pickup, marks[s],
                             raw_day if raw_day in raw.columns else None), SERVICE[s])
        for s, raw in known.items()
    ])
    if not lookback or target is None:
        return new
    recent = reduce(DataFrame.unionByName, [
        read_since(target.where(F.col("service_type") == s), "pickup_datetime", marks[s],
                   target_day)
        for s in known
    ])
    ids = recent.select(md5_key(HARMONIZED_KEY, "|").alias(ROW_ID))
    keyed = new.withColumn(ROW_ID, md5_key(HARMONIZED_KEY, "|"))
    return insert_only(keyed, ids, ROW_ID).drop(ROW_ID)


def load_increment(
    spark: SparkSession,
    raw_by_service: Mapping[str, DataFrame],
    table: str = "trip_data",
    *,
    by_day: bool = False,
    day_col: str = "pickup_date",
    partitions: int | None = None,
    location: str | None = None,
    **options,
) -> None:
    """Append each service's new rows to the harmonised table, creating it if absent.

    ``partitions`` fixes the number of writing tasks; by default they follow the
    plan. A table partitioned ``by_day`` finds its marks in its last days alone, and
    reports on it read only their range.
    """
    day_of = "pickup_datetime" if by_day else None
    ensure_table(spark, table, TRIP_DATA, day_of=day_of, day_col=day_col, location=location)
    new = harmonize_new_rows(raw_by_service, spark.table(table),
                             target_day=day_col if by_day else None, **options)
    if by_day:
        append_table(new, table, day_of=day_of, day_col=day_col, partitions=partitions)
    else:
        append_table(new.repartition(partitions) if partitions else new, table)


def load_arrivals(
    spark: SparkSession, path: str, service_name: str, table: str, checkpoint: str,
    *, location: str | None = None, every: str | None = None,
) -> StreamingQuery:
    """Harmonise a service's files as they arrive and append them to one table, each once.

    Unlike :func:`load_increment` this asks which files have come, not how far the target's
    times reach: trips that come late or out of order need no ``lookback``, and two trips
    of one moment are no question. Several services may fill one table, each with a
    checkpoint of its own.
    """
    trips = harmonize(stream_trip_files(spark, path, SERVICE[service_name]), SERVICE[service_name])
    return start_table(trips, table, checkpoint, source=service_name, location=location, every=every)


def write_report(
    trips: DataFrame,
    start: Moment,
    end: Moment | None = None,
    *,
    day_col: str | None = None,
    table: str | None = None,
    location: str | None = None,
    keep: int = 1,
) -> str:
    """Replace a report table, by default the one of ``start``'s year; returns its name.

    ``keep`` earlier versions stay for their readers.


    Without ``end`` the report covers the whole calendar year, its last second's
    fractions included.
    """
    half_open = end is None
    end = f"{report_year(start) + 1}-01-01 00:00:00" if end is None else end
    name = table or report_table_name(start)
    report = monthly_revenue(trips, start, end, half_open=half_open, day_col=day_col)
    replace_table(report, name, location=location, keep=keep)
    return name


def load_files_to_tables(
    spark: SparkSession,
    paths: str | Sequence[str],
    write: Callable[[DataFrame, str], None],
    parallel: int = 4,
) -> list[str]:
    """Write each CSV file or folder to the table named like it up to its first dot.

    ``paths`` is a glob or a list. Files of the same table name are loaded together, by
    column name. ``write`` takes a frame and a table name, for instance
    ``replace_table`` or a database writer; ``parallel`` tables are written at a time.
    Only the list of files is handled on the driver.
    """
    found = list_paths(spark, paths) if isinstance(paths, str) else paths
    sources: dict[str, list[str]] = {}
    for path in found:
        name = posixpath.basename(path.rstrip("/")).split(".")[0]
        sources.setdefault(name, []).append(path)

    def load(name: str) -> str:
        frames = [read_csv_files(spark, path).drop("filename") for path in sources[name]]
        write(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames), name)
        return name

    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(load, sources))


def project_with_defaults(
    docs: DataFrame,
    document: Column,
    fields: Sequence[str],
    default: str = "N/A",
    *,
    keep: Sequence[str] = (),
    as_text: bool = True,
) -> DataFrame:
    """The named fields of parsed documents, ``default`` where a key is missing.

    Values come as text, or as variants, which ``to_json`` writes with their own
    JSON types.
    """
    def value(field: str) -> Column:
        found = field_or_default(document, field, default)
        return (found.cast("string") if as_text else found).alias(field)

    return docs.select(*keep, *[value(f) for f in fields])
