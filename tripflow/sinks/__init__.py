"""Writers and table maintenance."""

from tripflow.sinks.compaction import compact_days, delete_replaced
from tripflow.sinks.files import stored, write_json_lines, write_parquet
from tripflow.sinks.jdbc import write_jdbc
from tripflow.sinks.messages import encode_messages, write_topic
from tripflow.sinks.tables import (
    append_table,
    ensure_table,
    register_stored,
    replace_table,
    truncate_table,
    write_day_partitioned,
)
from tripflow.sinks.versions import expire_versions, finished_versions

__all__ = [
    "append_table",
    "compact_days",
    "delete_replaced",
    "encode_messages",
    "ensure_table",
    "expire_versions",
    "finished_versions",
    "register_stored",
    "replace_table",
    "stored",
    "truncate_table",
    "write_day_partitioned",
    "write_jdbc",
    "write_json_lines",
    "write_parquet",
    "write_topic",
]
