"""Fields of JSON text, telling a missing key from a null value."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def field_or_default(document: Column, field: str, default: str) -> Column:
    """Field of a parsed document as a variant; ``default`` only if the key is missing.

    A key that is present with a JSON null yields a variant null, which is not an
    SQL null, so ``coalesce`` leaves it alone. A null document (no document, or
    text that does not parse) yields SQL null rather than the default.
    """
    found = F.variant_get(document, f"$[{json.dumps(field)}]", "variant")
    constant = F.parse_json(F.lit(json.dumps(default)))
    return F.when(document.isNotNull(), F.coalesce(found, constant))


def json_text(*columns: Column | str) -> Column:
    """One JSON object per row; null fields are written, not dropped."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
