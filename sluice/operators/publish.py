"""Staged, guarded publish of a table; landing of raw batches."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import quoted
from sluice.operators.keys import duplicate_keys

#: Shrink limit of merges, age at which staging tables are left-overs, most partitions dropped at once.
SHRINK_PERCENT, STAGING_HOURS, DROP_CAP = 20.0, 24, 1_000
_CREATED = "sluice.staging.created_ms"


class PublishError(RuntimeError):
    """A table that must not be published."""


def identifier(name: str) -> str:
    """The name, if it is plain enough to be put into SQL."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*", name):
        raise PublishError(f"{name!r} is no identifier")
    return name


@dataclass(frozen=True)
class Guards:
    """What staged rows must satisfy before they replace the table."""

    allow_empty: bool = False
    expected_count: int | None = None
    validation_query: str | None = None
    unique_keys: tuple[str, ...] = ()
    max_shrink_percent: float | None = None
    shrink_base: int | None = None


def check(spark: SparkSession, staged: str, target: str | None, g: Guards) -> int:
    """Number of staged rows; raises on the first guard that fails."""
    df = spark.table(staged)
    n = df.count()
    if n == 0 and not g.allow_empty:
        raise PublishError("the staged table is empty")
    if g.expected_count is not None and n != g.expected_count:
        raise PublishError(f"{n} rows staged, {g.expected_count} expected")
    if g.validation_query and not spark.sql(g.validation_query.replace("{table}", staged)).isEmpty():
        raise PublishError("the validation query returned rows")
    if g.unique_keys:
        bad = duplicate_keys(df, list(g.unique_keys)).limit(10).collect()
        if bad:
            raise PublishError(f"keys occur more than once, such as {[r.asDict() for r in bad]}")
    if g.max_shrink_percent is not None and target and spark.catalog.tableExists(target):
        before = spark.table(target).count() if g.shrink_base is None else g.shrink_base
        if before and 100.0 * (before - n) / before > g.max_shrink_percent:
            raise PublishError(f"the table would shrink from {before} to {n} rows")
    return n


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """The session's overwrite mode for one write; inserts by position don't take it as an option."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def publish(
    df: DataFrame, target: str, guards: Guards = Guards(), fmt: str = "parquet", partitions: tuple[str, ...] = (), scoped: bool = False, aside: tuple[str, ...] = (), inspect: Callable[[DataFrame], object] | None = None
) -> int:
    """Writes a staging table, checks it, then replaces the target in one statement; returns the rows published.

    With ``scoped`` only partitions present in ``df`` are replaced, otherwise all of the
    table. The plan of ``df`` may read the target: it is executed into staging first, once.
    Columns ``aside`` are staged but not published. ``inspect`` sees the staged rows, with
    them, before the target changes, and may refuse by raising. The staging table is dropped
    whatever happens. A missing target is created.
    """
    spark = df.sparkSession
    identifier(target)
    db, _, name = target.rpartition(".")
    staged = f"{db + '.' if db else ''}__stg_{name}_{uuid.uuid4().hex[:12]}"
    try:
        df.write.format(fmt).option("compression", "zstd" if fmt in ("parquet", "orc") else "none").saveAsTable(staged)
        spark.sql(f"ALTER TABLE {staged} SET TBLPROPERTIES ('{_CREATED}' = '{int(time.time() * 1000)}')")
        n = check(spark, staged, target, guards)
        rows = spark.table(staged)
        if inspect:
            inspect(rows)
        rows = rows.drop(*aside)
        if not spark.catalog.tableExists(target):
            rows.write.format(fmt).partitionBy(*partitions).saveAsTable(target)
        else:
            names = spark.table(target).columns
            with _overwrite_mode(spark, "dynamic" if scoped else "static"):
                rows.select(*[quoted(c) for c in names]).write.insertInto(target, overwrite=True)
        return n
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")


def droppable(partitions: DataFrame, cap: int = DROP_CAP) -> list:
    """The listed partitions; refuses more than ``cap``."""
    got = partitions.limit(cap + 1).collect()
    if len(got) > cap:
        raise PublishError(f"more than {cap} partitions would be dropped")
    return got


def drop_partitions(spark: SparkSession, target: str, partitions: DataFrame, cap: int = DROP_CAP) -> int:
    """Drops the listed partitions; refuses more than ``cap``. Null values name the default partition."""
    got = droppable(partitions, cap)
    for row in got:
        spec = ", ".join(f"`{c}` = " + ("null" if row[c] is None else "'" + str(row[c]).replace("\\", "\\\\").replace("'", "\\'") + "'") for c in partitions.columns)
        spark.sql(f"ALTER TABLE {identifier(target)} DROP IF EXISTS PARTITION ({spec})")
    return len(got)


def drop_stale_staging(spark: SparkSession, target: str, hours: int = STAGING_HOURS) -> list[str]:
    """Drops staging tables of ``target`` that a crashed run left behind."""
    db, _, name = identifier(target).rpartition(".")
    out = []
    for t in spark.sql(f"SHOW TABLES {f'IN {db} ' if db else ''}LIKE '__stg_{name.lower()}_*'").collect():
        full = f"{db + '.' if db else ''}{t.tableName}"
        made = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {full}").collect()}.get(_CREATED)
        if made and time.time() * 1000 - int(made) > hours * 3_600_000:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
            out.append(full)
    return out


def set_properties(spark: SparkSession, target: str, properties: dict[str, str]) -> bool:
    """Records table properties; writes nothing if they are recorded already."""
    have = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {identifier(target)}").collect()}
    new = {k: v for k, v in properties.items() if have.get(k) != v}
    if new:
        spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in new.items()) + ")")
    return bool(new)


METADATA_POLICIES = ("FAIL", "ALTER", "WARN")


def append_raw(df: DataFrame, target: str, fmt: str = "parquet", partitions: tuple[str, ...] = (), metadata: tuple[str, ...] = (), on_missing_metadata: str = "FAIL", path: str | None = None) -> None:
    """Appends a batch by column name; creates the table on first use.

    Metadata columns the table lacks fail (RAW_001), are added (ALTER) or are left out
    (WARN). A table column the batch lacks is an error.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(identifier(target)):
        w = df.write.format(fmt).partitionBy(*partitions)
        (w.option("path", path) if path else w).saveAsTable(target)
        return
    have = {c.lower(): c for c in spark.table(target).columns}
    new = [c for c in df.columns if c.lower() not in have and c.lower() in {m.lower() for m in metadata}]
    if new and on_missing_metadata == "FAIL":
        raise PublishError(f"RAW_001 {target} lacks metadata columns {', '.join(new)}")
    if new and on_missing_metadata == "ALTER":
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS (" + ", ".join(f"`{c}` {kinds[c]}" for c in new) + ")")
        spark.catalog.refreshTable(target)
    names = spark.table(target).columns
    own = {c.lower(): c for c in df.columns}
    missing = [c for c in names if c.lower() not in own]
    if missing:
        raise PublishError(f"the batch lacks columns {', '.join(missing)} of {target}; if they are partition columns, the partitioning differs")
    df.select(*[quoted(own[c.lower()]).alias(c) for c in names]).write.insertInto(target)


def append_control(spark: SparkSession, target: str, schema: str, rows: list[tuple]) -> None:
    """Appends events to a control table, created and widened as needed."""
    df = spark.createDataFrame(rows, schema)
    if not spark.catalog.tableExists(identifier(target)):
        df.write.format("parquet").saveAsTable(target)
        return
    append_raw(df, target, metadata=tuple(df.columns), on_missing_metadata="ALTER")


def table_count(spark: SparkSession, target: str) -> int:
    return spark.table(target).agg(F.count(F.lit(1))).first()[0]


def purge(spark: SparkSession, target: str, keep: DataFrame, dry_run: bool = False) -> int:
    """Rewrites a table with the rows to keep; returns how many go. Nothing is written for none."""
    gone = table_count(spark, target) - keep.count()
    if gone and not dry_run:
        publish(keep, target, Guards(allow_empty=True))
    return gone
