"""Data checks, each one aggregate over all rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import is_blank, quoted


class ValidationError(ValueError):
    """Data that breaks a contract; the message starts with its code."""


@dataclass(frozen=True)
class ContentRule:
    """Rules on the trimmed text of one column. Null fails every value rule."""

    regex: str | None = None
    min_length: int | None = None
    max_length: int | None = None
    allowed_values: tuple[str, ...] = ()
    nonblank: bool = False
    numeric: bool = False
    date_formats: tuple[str, ...] = ()
    timestamp_formats: tuple[str, ...] = ()
    max_null_percentage: float | None = None
    max_failure_percentage: float = 0.0

    def passes(self, c: Column) -> Column | None:
        """Whether the value passes; None if only nulls are limited."""
        t = F.trim(c.cast("string"))
        parts: list[Column] = []
        if self.regex is not None:
            parts.append(t.rlike(self.regex))
        if self.min_length is not None:
            parts.append(F.length(t) >= self.min_length)
        if self.max_length is not None:
            parts.append(F.length(t) <= self.max_length)
        if self.allowed_values:
            parts.append(t.isin(*self.allowed_values))
        if self.nonblank:
            parts.append(t != "")
        if self.numeric:
            parts.append(t.try_cast("double").isNotNull())
        for formats, read in ((self.date_formats, lambda f: F.try_to_date(t, f)), (self.timestamp_formats, lambda f: F.try_to_timestamp(t, F.lit(f)))):
            if formats:
                parts.append(F.coalesce(*[read(f) for f in formats]).isNotNull())
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out & p
        return F.coalesce(out, F.lit(False))


def content_failures(df: DataFrame, rules: dict[str, ContentRule]) -> DataFrame:
    """One row per rule column: rows, nulls, failures. Missing columns give no row; an empty table gives zeros."""
    have = {c.lower(): c for c in df.columns}
    checked = [(have[c.lower()], r) for c, r in rules.items() if c.lower() in have]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, (c, r) in enumerate(checked):
        ok = r.passes(quoted(c))
        aggs += [F.sum(quoted(c).isNull().cast("bigint")).alias(f"z{i}"), F.sum((~ok if ok is not None else F.lit(False)).cast("bigint")).alias(f"f{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.coalesce(f"z{i}", F.lit(0)).alias("n_null"), F.coalesce(f"f{i}", F.lit(0)).alias("n_failed")) for i, (c, _) in enumerate(checked)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*") if rows else one.filter("false").selectExpr("'' AS column_name", "n AS n_rows", "n AS n_null", "n AS n_failed")


def content_violations(df: DataFrame, rules: dict[str, ContentRule]) -> list[str]:
    """Columns over their failure or null limit."""
    by_name = {c.lower(): r for c, r in rules.items()}
    out = []
    for r in content_failures(df, rules).collect():
        rule, n = by_name[r.column_name.lower()], max(1, r.n_rows)
        if rule.passes(F.lit("")) is not None and 100.0 * r.n_failed / n > rule.max_failure_percentage:
            out.append(f"HDR_015 {r.column_name}: {r.n_failed} of {r.n_rows} values fail")
        if rule.max_null_percentage is not None and 100.0 * r.n_null / n > rule.max_null_percentage:
            out.append(f"HDR_015 {r.column_name}: {r.n_null} of {r.n_rows} values are null")
    return out


def sample_rows(df: DataFrame, n: int, seed: int = 42, total: int | None = None) -> DataFrame:
    """About ``n`` rows, at most that many: the sampling operator for cheap content validation."""
    total = df.count() if total is None else total
    return df if total <= n else df.sample(False, min(1.0, 1.2 * n / total), seed).limit(n)


def cast_losses(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """One row per column: values that aren't null but would be after the cast."""
    have = {c.lower(): c for c in df.columns}
    checked = [(have[c.lower()], t) for c, t in types.items() if c.lower() in have]
    sums = [F.coalesce(F.sum((quoted(c).isNotNull() & quoted(c).try_cast(t).isNull()).cast("bigint")), F.lit(0)).alias(f"l{i}") for i, (c, t) in enumerate(checked)]
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.col(f"l{i}").alias("n_lost")) for i, (c, t) in enumerate(checked)]
    return df.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_counts(df: DataFrame, columns: list[str], blank: bool = False) -> DataFrame:
    """One row per column: nulls (or blanks too) among all rows."""
    bad = is_blank if blank else (lambda c: c.isNull())
    sums = [F.coalesce(F.sum(bad(quoted(c)).cast("bigint")), F.lit(0)).alias(f"n{i}") for i, c in enumerate(columns)]
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n_rows"), F.col(f"n{i}").alias("n_null")) for i, c in enumerate(columns)]
    return df.agg(F.count(F.lit(1)).alias("n"), *sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def all_null_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns without any value in a table that has rows."""
    return [r.column_name for r in null_counts(df, columns).collect() if r.n_rows and r.n_null == r.n_rows]


def control_total(df: DataFrame, expression: str) -> DataFrame:
    """One row with an aggregate expression over all rows, as text."""
    return df.agg(F.expr(expression).cast("string").alias("control_total"))


def partition_skew(df: DataFrame) -> DataFrame:
    """One row: most rows of a partition against the mean of those that hold rows."""
    per = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.max("n").alias("largest"), F.avg("n").alias("mean"), (F.max("n") / F.avg("n")).alias("ratio"))
