"""What survives retention."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import quoted
from sluice.operators.keys import keep_last


def parse_days(text: str) -> int:
    """``400d`` is 400 days."""
    m = re.fullmatch(r"\s*(\d+)d\s*", text)
    if not m:
        raise ValueError(f"PIPE_004 retention period {text!r} must be like 400d")
    return int(m.group(1))


def survivors_since(df: DataFrame, time: str, cutoff) -> DataFrame:
    """Rows from the cutoff on; rows without time are kept."""
    return df.filter(quoted(time).isNull() | (quoted(time) >= F.lit(cutoff)))


def expired_partitions(partitions: DataFrame, column: str, cutoff) -> DataFrame:
    """Partitions whose value is a day before the cutoff; unreadable values are kept."""
    return partitions.filter(F.coalesce(F.try_to_date(quoted(column).cast("string"), "yyyy-MM-dd") < F.lit(cutoff).cast("date"), F.lit(False)))


def keep_watermarks(df: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` versions of each entity's watermark."""
    if n < 1:
        raise ValueError("PIPE_004 at least one watermark version must be kept")
    return keep_last(df, ["entity"], ["watermark_version desc", "updated_ts desc"], n)
