"""Comparing two result frames as multisets of rows."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime

import pandas as pd


def _text(value) -> str:
    if value is None or value is pd.NaT or value is pd.NA or (
            isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (pd.Timestamp, datetime)):
        return value.isoformat()
    # One engine gives a day as a date, the other as its midnight.
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return str(value)


def rows_of(df: pd.DataFrame) -> Counter:
    ordered = df[sorted(df.columns)]
    columns = []
    for name in ordered.columns:
        column = ordered[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            column = column.astype("datetime64[us]")
        columns.append([_text(v) for v in column.tolist()])
    return Counter(zip(*columns)) if columns else Counter()


def differences(found: pd.DataFrame, wanted: pd.DataFrame) -> str:
    """Empty if the frames hold the same rows, else what differs."""
    if sorted(found.columns) != sorted(wanted.columns):
        return f"columns {sorted(found.columns)} != {sorted(wanted.columns)}"
    left, right = rows_of(found), rows_of(wanted)
    if left == right:
        return ""
    only_left, only_right = left - right, right - left
    return (f"{len(found)} rows vs {len(wanted)}; only here {list(only_left)[:2]}; "
            f"only in SQL {list(only_right)[:2]}")
