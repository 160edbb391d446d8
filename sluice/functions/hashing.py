"""Content hashes and key hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import quoted

#: Separator and stand-in for null of the record hash.
SEPARATOR, NULL_MARK = "\u0001", "\u0000"


def record_hash(columns: list[str], trim: bool = False, upper: bool = False) -> Column:
    """SHA-256 over the columns in case-insensitive name order, as strings; the empty string for no columns.

    Nulls and empty strings hash differently. Equal contents hash equally whatever the
    order of the columns.
    """
    if not columns:
        return F.lit("")

    def part(name: str) -> Column:
        c = quoted(name).cast("string")
        c = F.trim(c) if trim else c
        return F.coalesce(F.upper(c) if upper else c, F.lit(NULL_MARK))

    return F.sha2(F.concat_ws(SEPARATOR, *map(part, sorted(columns, key=str.lower))), 256)


def key_json(columns: list[str]) -> Column:
    """The key as JSON with its nulls."""
    return F.to_json(F.struct(*[quoted(c).alias(c) for c in columns]), {"ignoreNullFields": "false"})


def key_hash(columns: list[str]) -> Column:
    return F.concat(F.lit("v1:"), F.sha2(key_json(columns), 256))


def file_id(c: Column) -> Column:
    return F.sha2(c, 256)
