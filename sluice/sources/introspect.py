"""Feeds from what a database says about its tables, and previews of what a feed would read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from sluice import config
from sluice.functions.text import normalize_header
from sluice.operators import watermark as wm
from sluice.operators.contract import Contract, ContractColumn
from sluice.sources.jdbc import JdbcSource, relation
from sluice.sources.sqltext import SqlError

#: Numbers of the JDBC types by the Spark type they become; all others are text.
JDBC_TYPES = {
    "tinyint": (-6,),
    "smallint": (5,),
    "int": (4,),
    "bigint": (-5,),
    "float": (7,),
    "double": (6, 8),
    "boolean": (-7, 16),
    "date": (91,),
    "timestamp": (93, 2014),
    "binary": (-2, -3, -4, 2004),
    "decimal": (2, 3),
}
_BY_NUMBER = {n: name for name, numbers in JDBC_TYPES.items() for n in numbers}


def spark_type(number: int, size: int = 0, scale: int = 0) -> str:
    name = _BY_NUMBER.get(number, "string")
    if name != "decimal":
        return name
    return f"decimal({size},{max(scale, 0)})" if size > 0 else "decimal(38,18)"


def table_columns(spark: SparkSession, source: JdbcSource, table: str, schema: str | None = None) -> list[tuple[str, str, bool]]:
    """(name, Spark type, nullable) of a table's columns, by the driver's metadata."""
    spark._jvm.java.lang.Class.forName(source.properties.get("driver", source.dialect.driver)) if source.dialect.driver or "driver" in source.properties else None
    connection = spark._jvm.java.sql.DriverManager.getConnection(source.url)
    try:
        found = connection.getMetaData().getColumns(None, schema, table, None)
        out = []
        while found.next():
            out.append((found.getString("COLUMN_NAME"), spark_type(found.getInt("DATA_TYPE"), found.getInt("COLUMN_SIZE"), found.getInt("DECIMAL_DIGITS")), found.getInt("NULLABLE") != 0))
        return out
    finally:
        connection.close()


def primary_key(spark: SparkSession, source: JdbcSource, table: str, schema: str | None = None) -> list[str]:
    """The columns of a table's primary key, in its order."""
    connection = spark._jvm.java.sql.DriverManager.getConnection(source.url)
    try:
        found, out = connection.getMetaData().getPrimaryKeys(None, schema, table), []
        while found.next():
            out.append((found.getShort("KEY_SEQ"), found.getString("COLUMN_NAME")))
        return [name for _, name in sorted(out)]
    finally:
        connection.close()


@dataclass(frozen=True)
class Draft:
    """A feed's configuration and contract as far as the database tells, what was decided how, and what is left to be said."""

    conf: dict
    contract: Contract
    decided: tuple[str, ...]
    open: tuple[str, ...]


#: Words in the names of columns that hold the time of the last change, likeliest first.
_CHANGE_WORDS = ("modified", "updated", "changed", "last_upd", "upd_ts")


def draft(columns: list[tuple[str, str, bool]], keys: list[str], entity: str, table: str, answers: dict[str, object] | None = None) -> Draft:
    """A feed for a table. ``answers`` settle what the columns leave open: ``watermark`` (a column, or None for full loads), ``keys``, ``partitions``.

    A watermark is proposed if one column that can't be null, or only one at all, is named
    like a time of change, else a whole-number key of one column; keys come from the primary key.
    """
    answers, decided, left = answers or {}, [], []
    kinds = {n: t for n, t, _ in columns}
    keys = list(answers.get("keys", keys))
    unknown = [c for c in [*keys, *([answers["watermark"]] if answers.get("watermark") else [])] if c not in kinds]
    if unknown:
        raise ValueError(f"columns {', '.join(unknown)} aren't in {table}")
    decided.append(f"keys {', '.join(keys)}") if keys else left.append("keys: the table has no primary key; without keys no current state can be derived")
    stamps = [(n, nullable) for w in _CHANGE_WORDS for n, t, nullable in columns if t == "timestamp" and w in n.lower()]
    sure = list(dict.fromkeys(n for n, nullable in stamps if not nullable)) or list(dict.fromkeys(n for n, _ in stamps))
    mark = answers["watermark"] if "watermark" in answers else sure[0] if len(sure) == 1 else None
    if "watermark" not in answers:
        if len(sure) > 1:
            left.append(f"watermark: {', '.join(sure)} all may be the time of the last change")
        elif mark is None and len(keys) == 1 and kinds[keys[0]] in ("int", "bigint"):
            mark = keys[0]
            decided.append(f"watermark {mark}: a growing key sees inserts only")
        elif mark is None:
            left.append("watermark: no column tells the last change; every run loads all")
        else:
            decided.append(f"watermark {mark}: the only time of change")
    source: dict = {"type": "jdbc", "table": table, "mode": "INCREMENTAL" if mark else "FULL_TABLE"}
    if mark:
        source["incremental"] = {"watermark_column": mark, "watermark_type": "TIMESTAMP" if kinds[mark] == "timestamp" else "NUMERIC"}
    if len(keys) == 1 and kinds[keys[0]] in ("int", "bigint") and int(answers.get("partitions", 1)) > 1:
        source["partitioning"] = {"column": keys[0], "partitions": int(answers["partitions"]), "bounds": "MINMAX"}
    conf: dict = {"entity": entity, "source": source, "raw": {"table": f"raw.{entity}", "idempotency_key": [*keys, *([mark] if mark and mark not in keys else [])], "delivery_mode": "DEDUPLICATED_APPEND" if keys and mark else "AT_LEAST_ONCE_APPEND"}}
    if keys:
        normal = [normalize_header(k) for k in keys]
        conf["curated"] = {"table": f"curated.{entity}", "strategy": "TYPE1_MERGE", "merge": {"keys": normal, **({"freshness": {"column": normalize_header(mark)}} if mark else {})}}
    return Draft(conf, contract_of(columns, tuple(keys)), tuple(decided), tuple(left))


def contract_of(columns: list[tuple[str, str, bool]], keys: tuple[str, ...] = ()) -> Contract:
    """A contract with normalized names; the database's own names are aliases."""
    return Contract(tuple(ContractColumn(normalize_header(n), t, nullable, () if normalize_header(n) == n else (n,), i, business_key=n in keys) for i, (n, t, nullable) in enumerate(columns)))


def preview(source: JdbcSource, parameters: dict[str, str] | None = None) -> str:
    """The SQL a feed would send first; secrets are to be passed masked."""
    window = None
    if source.watermark and source.initial:
        window = wm.predicate_sql(source.watermark, source.initial, source.dialect.quote)
    try:
        return relation(source, window, parameters)
    except SqlError as e:
        return f"-- no preview: {e}"


def dry_run(conf: dict, source: JdbcSource | None = None) -> tuple[list[str], str | None]:
    """(problems, preview) of a feed, without touching any system."""
    missing = [f"{p} is required" for p in ("entity", "source.type", "raw.table") if config.get(conf, p) is None]
    kind = config.get(conf, "source.type")
    if kind is not None and str(kind).lower() not in ("file", "jdbc", "kafka"):
        missing.append(f"source type {kind!r} is unknown")
    return missing + config.problems(conf), preview(source) if source else None
