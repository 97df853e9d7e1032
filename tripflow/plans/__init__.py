"""Jobs composed from the operators."""

from tripflow.plans.daily_report import daily_sums, refresh_daily_sums, report_from_sums
from tripflow.plans.jobs import (
    harmonize_new_rows,
    load_arrivals,
    load_files_to_tables,
    load_increment,
    merge_into_table,
    project_with_defaults,
    staged_merge,
    write_report,
)

__all__ = [
    "daily_sums",
    "harmonize_new_rows",
    "load_arrivals",
    "load_files_to_tables",
    "load_increment",
    "merge_into_table",
    "project_with_defaults",
    "refresh_daily_sums",
    "report_from_sums",
    "staged_merge",
    "write_report",
]
