"""Type names, checked with or without a running session."""

from __future__ import annotations

import re

from pyspark import SparkContext
from pyspark.sql import types as T

_PLAIN = re.compile(r"(?i)\s*(tinyint|byte|smallint|short|int|integer|bigint|long|float|real|double|boolean|string|binary|date|timestamp|timestamp_ntz|timestamp_ltz|(decimal|dec|numeric)(\s*\(\s*\d+\s*(,\s*\d+\s*)?\))?|(var)?char\s*\(\s*\d+\s*\))\s*")


def is_type(text: str) -> bool:
    """Whether Spark knows the type; nested types need a running session to be recognized."""
    if _PLAIN.fullmatch(text):
        return True
    if SparkContext._active_spark_context is None:
        return bool(re.match(r"(?i)\s*(array|map|struct)\s*<.*>\s*$", text))
    try:
        T.DataType.fromDDL(text)
        return True
    except Exception:  # noqa: BLE001 - any parse failure means the same
        return False
