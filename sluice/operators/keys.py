"""Business keys: blank keys, the latest row per key, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.order import OrderError, OrderTerm, parse_terms, resolve
from sluice.functions.text import is_blank, quoted


def blank_key(keys: list[str]) -> Column:
    """True if any key column is null or blank; never null."""
    out = F.lit(False)
    for k in keys:
        out = out | is_blank(quoted(k))
    return out


def split_blank_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows without); together all rows."""
    b = blank_key(keys)
    return df.filter(~b), df.filter(b)


def normalize_keys(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Replaces key columns by SQL expressions over the row; refuses missing columns."""
    missing = [c for c in expressions if c.lower() not in {x.lower() for x in df.columns}]
    if missing:
        raise ValueError(f"CUR_010 key column(s) {', '.join(missing)} are missing")
    return df.withColumns({c: F.expr(e) for c, e in expressions.items()})


def latest_per_key(df: DataFrame, keys: list[str], order: str | list[str] | list[OrderTerm], require_order: bool = False) -> DataFrame:
    """The first row of each key in the given order; null keys form a key of their own.

    Without an order any one row per key is kept, or an error raised if
    ``require_order``. Rank 1 is filtered on each input partition before the shuffle, so
    a hot key sends one row per partition. Full ties are decided by nothing: give a
    total order where that matters.
    """
    terms = order if order and isinstance(order[0], OrderTerm) else parse_terms(order)
    if not terms:
        if require_order:
            raise OrderError("CUR_004 an order is required to choose between rows of one key")
        return df.dropDuplicates(keys)
    terms = resolve(terms, df.columns)
    w = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*[t.sort() for t in terms])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def keep_last(df: DataFrame, group: list[str], order: str | list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group in the given order."""
    terms = resolve(parse_terms(order), df.columns)
    w = Window.partitionBy(*[quoted(g) for g in group]).orderBy(*[t.sort() for t in terms])
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def duplicate_keys(df: DataFrame, keys: list[str], with_blank: bool = False) -> DataFrame:
    """Keys found more than once with their number of rows; keys with nulls only if ``with_blank``."""
    rows = df
    if not with_blank:
        for k in keys:
            rows = rows.filter(quoted(k).isNotNull())
    return rows.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def unchecked_casts(df: DataFrame, terms: list[OrderTerm]) -> DataFrame:
    """Rows with a value that can't be read as the type it is to be compared as."""
    bad = F.lit(False)
    for t in resolve(terms, df.columns):
        if t.kind or t.pattern:
            bad = bad | (quoted(t.column).isNotNull() & t.value().isNull())
    return df.filter(bad)
