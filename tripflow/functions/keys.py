"""Row ids built from column values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_key(columns: Sequence[Column | str], sep: str = "") -> Column:
    """Text of the columns in order, nulls as empty text, so never null.

    Without a separator ``1, 12`` and ``11, 2`` give the same id. That is the
    default because existing tables hold such ids; pass ``sep`` for new ones.
    Cast floating-point columns to a decimal first: Spark writes large doubles
    in scientific notation.
    """
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def md5_key(columns: Sequence[Column | str], sep: str = "") -> Column:
    """Hex MD5 of :func:`concat_key`."""
    return F.md5(concat_key(columns, sep))


def plain_number(column: Column | str) -> Column:
    """An amount's digits without needless zeros or an exponent: ``12.5``, ``12``, ``0``.

    So do databases print double precision numbers of up to fifteen digits.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(value.cast("decimal(38,9)").cast("string"), r"\.?0+$", "")
