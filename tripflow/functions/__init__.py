"""Column expressions; all of them stay inside the JVM."""

from tripflow.functions.json_fields import field_or_default, json_text
from tripflow.functions.keys import concat_key, md5_key, plain_number
from tripflow.functions.times import hours_between, millis_to_timestamp, time_literal

__all__ = [
    "concat_key",
    "field_or_default",
    "hours_between",
    "json_text",
    "md5_key",
    "plain_number",
    "millis_to_timestamp",
    "time_literal",
]
