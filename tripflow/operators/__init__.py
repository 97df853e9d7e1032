"""DataFrame-in, DataFrame-out operators."""

from tripflow.operators.bitmaps import count_bitmaps, distinct_bitmaps, merged_bitmaps
from tripflow.operators.explore import (
    count_distinct,
    count_rows,
    count_where,
    distinct_values,
    longest_hours,
    mean_by_group,
    on_day,
    same_day,
    time_at,
)
from tripflow.operators.harmonize import harmonize, union_services
from tripflow.operators.marks import high_water_mark, latest_marks
from tripflow.operators.merge import (
    days_of,
    insert_only,
    insert_only_bucketed,
    insert_only_stored,
    on_days,
    with_row_id,
)
from tripflow.operators.report import monthly_revenue, report_table_name
from tripflow.operators.sessions import session_counts, session_counts_by_span
from tripflow.operators.windows import tumbling_counts
from tripflow.operators.zones import least_frequent_zones, with_zone, zone_counts

__all__ = [
    "count_bitmaps",
    "count_distinct",
    "count_rows",
    "count_where",
    "distinct_bitmaps",
    "distinct_values",
    "harmonize",
    "high_water_mark",
    "days_of",
    "insert_only",
    "insert_only_bucketed",
    "insert_only_stored",
    "on_days",
    "latest_marks",
    "least_frequent_zones",
    "longest_hours",
    "mean_by_group",
    "merged_bitmaps",
    "monthly_revenue",
    "on_day",
    "report_table_name",
    "same_day",
    "session_counts",
    "session_counts_by_span",
    "time_at",
    "tumbling_counts",
    "union_services",
    "with_row_id",
    "with_zone",
    "zone_counts",
]
