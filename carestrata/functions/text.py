"""String and identity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reference_id(reference: Column, target: str) -> Column:
    """Id inside a reference such as ``Patient/123``.

    Absolute URLs match too, a trailing ``/_history/n`` is left out, and no match gives null.
    """
    return F.nullif(F.regexp_extract(reference, f"{target}/([^/]+)", 1), F.lit(""))


def business_hash(columns: list[str]) -> Column:
    """SHA-256 over the text of ``columns``, null as empty, joined by two bars."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("||", *parts), 256)


def structural_hash(columns: list[str]) -> Column:
    """SHA-256 over the JSON of the row, which tells null from empty and cannot collide on separators."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
