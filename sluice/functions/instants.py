"""Instants as microseconds since 1970, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def micros_of(c: Column, kind: T.DataType) -> Column:
    """Microseconds of a timestamp column; one without zone is read as UTC."""
    if isinstance(kind, T.TimestampNTZType):
        day = F.unix_date(c.cast("date")).cast("bigint")
        seconds = day * 86_400 + F.hour(c).cast("bigint") * 3_600 + F.minute(c).cast("bigint") * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint") * 86_400_000_000
    raise TypeError(f"no instant: {kind.simpleString()}")


def instant_text_micros(c: Column) -> Column:
    """Microseconds of a serialized instant; null for null, blank and unreadable text.

    Plain digits are microseconds already, a text without offset is UTC.
    """
    t = F.trim(c)
    digits = F.when(t.rlike(r"^-?\d+$"), t.try_cast("bigint"))
    zoned = F.when(t.rlike(r"([zZ]|[+-]\d{2}:?\d{2})$") & t.rlike(r"\d:\d"), t).otherwise(F.concat(t, F.lit("Z")))
    return F.coalesce(digits, F.when(~t.rlike(r"^-?\d*$"), F.unix_micros(zoned.try_cast("timestamp"))))


INSTANT_TEXT_SQL = r"""CASE WHEN regexp_full_match(trim({c}), '-?\d+') THEN try_cast(trim({c}) AS bigint)
 WHEN regexp_matches(trim({c}), '([zZ]|[+-]\d\d:?\d\d)$') AND regexp_matches(trim({c}), '\d:\d') THEN epoch_us(try_cast(trim({c}) AS timestamptz))
 ELSE epoch_us(try_cast(trim({c}) || 'Z' AS timestamptz)) END"""
