"""Row-level rejects: accepted rows apart from rejected ones with code and reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import quoted

#: Columns of the reject table.
REJECT_COLUMNS = ("run_id", "entity", "file_id", "source_file", "row_idx", "raw_record", "error_code", "error_message", "reject_category", "reject_ts")


class RejectLimitError(ValueError):
    """More rejects than allowed."""


@dataclass(frozen=True)
class RejectRule:
    """Rejects rows for which ``condition`` (SQL) is true; null isn't true."""

    name: str
    condition: str
    error_code: str
    message: str
    category: str = "CONTENT"

    def column(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def required_rule(column: str, code: str = "NOT_NULL") -> RejectRule:
    c = "`" + column.replace("`", "``") + "`"
    return RejectRule(f"{column}_required", f"{c} IS NULL OR trim(cast({c} AS string)) = ''", code, f"{column} is null or blank", "NULLABILITY")


def classify(df: DataFrame, rules: list[RejectRule]) -> DataFrame:
    """Adds error_code, error_message, reject_category of the first rule that applies; null for accepted rows."""
    code = message = category = F.lit(None).cast("string")
    for r in reversed(rules):
        hit = r.column()
        code = F.when(hit, F.lit(r.error_code)).otherwise(code)
        message = F.when(hit, F.lit(r.message)).otherwise(message)
        category = F.when(hit, F.lit(r.category)).otherwise(category)
    return df.withColumns({"error_code": code, "error_message": message, "reject_category": category})


def split(df: DataFrame, rules: list[RejectRule]) -> tuple[DataFrame, DataFrame]:
    """(accepted with the columns of ``df``, rejected with reasons); every row is in exactly one."""
    c = classify(df, rules)
    return c.filter(F.col("error_code").isNull()).drop("error_code", "error_message", "reject_category"), c.filter(F.col("error_code").isNotNull())


def summary(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("error_code", "reject_category").agg(F.count(F.lit(1)).alias("n_rows"))


def payload(columns: list[str], mode: str, keys: list[str] = (), sensitive: list[str] = ()) -> Column:
    """The rejected record as JSON.

    FULL as it is; HASHED has the SHA-256 of every value; MASKED hashes the sensitive
    columns, of which there must be some; KEYS_ONLY has the key columns, sensitive ones
    hashed. Null values are left out.
    """
    hidden = {s.lower() for s in sensitive}
    if mode not in ("FULL", "MASKED", "HASHED", "KEYS_ONLY"):
        raise ValueError(f"payload mode {mode!r} must be FULL, MASKED, HASHED or KEYS_ONLY")
    if mode == "MASKED" and not hidden:
        raise ValueError("payload mode MASKED needs sensitive columns, else it would mask nothing")
    if mode == "KEYS_ONLY" and not keys:
        raise ValueError("payload mode KEYS_ONLY needs the key columns")
    digest = lambda c: F.sha2(quoted(c).cast("string"), 256)
    secret = lambda c: mode == "HASHED" or mode != "FULL" and c.lower() in hidden
    return F.to_json(F.struct(*[(digest(c) if secret(c) else quoted(c)).alias(c) for c in (keys if mode == "KEYS_ONLY" else columns)]))


def check_limits(n_total: int, n_rejected: int, max_count: int | None = None, max_percent: float | None = None) -> None:
    if max_count is not None and n_rejected > max_count:
        raise RejectLimitError(f"{n_rejected} rejects exceed the limit of {max_count}")
    if max_percent is not None and n_total and 100.0 * n_rejected / n_total > max_percent:
        raise RejectLimitError(f"{n_rejected} of {n_total} rows rejected exceed {max_percent} percent")


def replaced_slice(existing: DataFrame, new: DataFrame, on: dict[str, str], ignore: tuple[str, ...] = ("reject_ts",)) -> DataFrame | None:
    """The reject table with the slice ``on`` replaced by ``new``; None if the slice already holds the same rows."""
    same = F.lit(True)
    for k, v in on.items():
        same = same & F.coalesce(F.col(k) == v, F.lit(False))
    old = existing.filter(same)
    compared = [c for c in existing.columns if c not in ignore]
    a, b = old.select(*compared), new.select(*compared)
    if a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty():
        return None
    return existing.filter(~same).unionByName(new.select(*existing.columns))
