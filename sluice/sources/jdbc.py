"""Reading from databases: full tables, queries, and bounded incremental windows.

Filters, projection and window are rendered into the subquery, so the database does the
work. The window's upper bound is captured on the driver before the read and committed
only after the whole run has succeeded.
"""

from __future__ import annotations

import random
import re
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from sluice import config
from sluice.operators import watermark as wm
from sluice.operators.watermark import WatermarkError, WatermarkSpec
from sluice.sources.kinds import Registry
from sluice.sources.sqltext import Dialect, Filter, Projection, SqlError, dialect, render_template, single_select

#: Defaults of fetch size, partitions, retry, clock drift.
FETCH_SIZE, MAX_PARTITIONS, ATTEMPTS, BACKOFF_MS, DRIFT_SECONDS = 1_000, 64, 3, 2_000, 30
MODES = ("FULL_TABLE", "SELECT_QUERY", "CUSTOM_SQL", "SQL_TEMPLATE", "INCREMENTAL")


class JdbcError(RuntimeError):
    """A read that can't be trusted; the message starts with its code."""


@dataclass(frozen=True)
class JdbcSource:
    url: str
    mode: str = "FULL_TABLE"
    table: str | None = None
    sql: str | None = None
    columns: tuple[Projection, ...] = ()
    filters: tuple[Filter, ...] = ()
    watermark: WatermarkSpec | None = None
    upper_from: str = "MAX_VALUE"
    initial: tuple[str, ...] | None = None
    allow_null_watermarks: bool = False
    dialect_name: str = "generic"
    properties: dict[str, str] = field(default_factory=dict, hash=False)
    fetch_size: int = FETCH_SIZE
    partition_column: str | None = None
    partitions: int = 1
    lower_bound: str | None = None
    upper_bound: str | None = None
    discover_bounds: bool = False
    predicates: tuple[str, ...] = ()
    authentication: str | None = None
    bound_full_load: bool = True

    def __post_init__(self):
        if self.mode not in MODES:
            raise JdbcError(f"mode {self.mode!r} must be one of {', '.join(MODES)}")
        if self.partitions > MAX_PARTITIONS or len(self.predicates) > MAX_PARTITIONS:
            raise JdbcError(f"at most {MAX_PARTITIONS} partitions are allowed")
        given = [x is not None for x in (self.partition_column, self.lower_bound, self.upper_bound)]
        if any(given) and not all(given) and not self.discover_bounds:
            raise JdbcError("range partitions need a column and both bounds, or discovered bounds")
        if self.mode == "INCREMENTAL" and self.watermark is None:
            raise JdbcError("INCREMENTAL needs a watermark")
        if self.watermark and self.watermark.convention == wm.HALF_OPEN and self.upper_from != "SOURCE_CLOCK":
            raise JdbcError("half-open windows need SOURCE_CLOCK: a MAX_VALUE bound would never deliver its own row")

    @property
    def dialect(self) -> Dialect:
        return dialect(self.dialect_name)


def base_query(s: JdbcSource, parameters: dict[str, str] | None = None) -> str:
    """The relation read, without window: a table name or a parenthesized query."""
    if s.mode in ("CUSTOM_SQL", "SQL_TEMPLATE") or (s.mode == "INCREMENTAL" and s.sql):
        if not s.sql:
            raise SqlError(f"{s.mode} needs SQL")
        text = render_template(s.sql, parameters or {}) if parameters or s.mode == "SQL_TEMPLATE" else s.sql
        return f"({single_select(text)})"
    if not s.table:
        raise SqlError(f"{s.mode} needs a table")
    return s.dialect.quote(s.table)


def relation(s: JdbcSource, window: str | None = None, parameters: dict[str, str] | None = None, cutoff: str | None = None) -> str:
    """What is handed to the database as the table to read."""
    base = base_query(s, parameters)
    where = [f.render(s.dialect) for f in s.filters] + [f"({w})" for w in (window, cutoff) if w]
    cols = ", ".join(c.render(s.dialect) for c in s.columns) or "*"
    if cols == "*" and not where:
        return base if not base.startswith("(") else f"{base} src"
    inner = base if not base.startswith("(") else f"{base} base_rows"
    return f"(SELECT {cols} FROM {inner}{' WHERE ' + ' AND '.join(where) if where else ''}) src"


def masked(url: str) -> str:
    """The URL without credentials."""
    return re.sub(r"(?i)(password|pwd|user|token|secret)=[^;&]*", r"\1=***", re.sub(r"//[^/@]*@", "//***@", url))


#: Classes of SQLSTATE, and vendors' own error codes, of faults that pass by themselves.
TRANSIENT_STATES = ("08", "40", "53", "57")
TRANSIENT_CODES = {
    "db2": (-904, -911, -913),
    "mysql": (1040, 1205, 1213),
    "oracle": (60, 3113, 3114, 12170, 12541),
    "sqlserver": (1205, 1222, 40197, 40501, 40613, 49918),
}


@dataclass(frozen=True)
class SqlFailure:
    """What a driver said: class of the exception, SQLSTATE, vendor code."""

    kind: str
    state: str
    code: int


def sql_failures(error: BaseException) -> list[SqlFailure]:
    """All SQL exceptions among the causes of an error that came from the JVM, outermost first."""
    out, at = [], getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    at = at.java_exception if isinstance(at, Py4JJavaError) else at
    gateway = SparkContext._gateway
    while at is not None and gateway is not None and len(out) < 20:
        if is_instance_of(gateway, at, "java.sql.SQLException"):
            out.append(SqlFailure(at.getClass().getName(), at.getSQLState() or "", int(at.getErrorCode())))
        at = at.getCause()
    return out


def is_transient(error: BaseException, vendor: str = "") -> bool:
    """Whether trying again may help: by exception class, SQLSTATE and vendor code, else as any failure is classified."""
    found = sql_failures(error)
    if not found:
        return config.classify(error) is config.TRANSIENT
    passing = lambda f: "Transient" in f.kind and "NonTransient" not in f.kind or "Recoverable" in f.kind or f.state[:2] in TRANSIENT_STATES or f.code in TRANSIENT_CODES.get(vendor.lower(), ())
    return any(map(passing, found))


def with_retry(call: Callable, attempts: int = ATTEMPTS, backoff_ms: int = BACKOFF_MS, sleep: Callable[[float], None] = time.sleep, vendor: str = ""):
    """Calls again after transient failures, each time waiting twice as long, with jitter."""
    for n in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:
            if n == attempts or not is_transient(e, vendor):
                raise
            sleep(backoff_ms / 1000 * 2 ** (n - 1) * (0.5 + random.random()))
    raise AssertionError


def _reader(spark: SparkSession, s: JdbcSource):
    r = spark.read.format("jdbc").option("url", s.url).option("fetchsize", s.fetch_size)
    if s.dialect.driver and "driver" not in s.properties:
        r = r.option("driver", s.dialect.driver)
    return r.options(**(AUTHENTICATION.get(s.authentication)(s.properties) if s.authentication else s.properties))


#: How credentials become connection properties, by name: functions of the configured properties.
AUTHENTICATION: Registry = Registry("authentication")
AUTHENTICATION.register("password", lambda p: p)
AUTHENTICATION.register("integrated", lambda p: {k: v for k, v in p.items() if k not in ("user", "password")} | {"integratedSecurity": "true"})
AUTHENTICATION.register("token", lambda p: {k: v for k, v in p.items() if k not in ("user", "password", "token")} | {"accessToken": p["token"]})


def first(spark: SparkSession, s: JdbcSource, query: str):
    """The first row of a query's answer; asked again after passing faults."""
    return with_retry(lambda: ask(spark, s, query).first(), vendor=s.dialect_name)


def ask(spark: SparkSession, s: JdbcSource, query: str) -> DataFrame:
    """A query answered by one connection."""
    return _reader(spark, s).option("dbtable", f"({query}) q").load()


def _probe(spark: SparkSession, s: JdbcSource, query: str, alias: str) -> DataFrame:
    return _reader(spark, s).option("dbtable", f"({query}) {alias}" if query.startswith("VALUES") else f"({query}) q").load()


def health_check(spark: SparkSession, s: JdbcSource, executors: bool = False) -> int:
    """Whether the database answers, from the driver's plan and, if asked, from as many tasks at once as the cluster has cores.

    Returns how many tasks got an answer.
    """
    try:
        with_retry(lambda: _probe(spark, s, s.dialect.probe, "q(x)").collect(), vendor=s.dialect_name)
        if not executors:
            return 1
        n = spark.sparkContext.defaultParallelism
        probe = s.dialect.probe.removesuffix(";")
        props = {"fetchsize": "1", **({"driver": s.dialect.driver} if s.dialect.driver else {}), **s.properties}
        table = f"({probe}) q(x)" if probe.startswith("VALUES") else f"({probe}) q"
        return spark.read.jdbc(s.url, table, predicates=["1 = 1"] * n, properties=props).count()
    except Exception as e:
        raise JdbcError(f"JDBC_001 {masked(s.url)} can't be reached: {type(e).__name__}") from e


def read(spark: SparkSession, s: JdbcSource, window: str | None = None, parameters: dict[str, str] | None = None, cutoff: str | None = None) -> DataFrame:
    """The rows, in as many partitions as configured."""
    rel = relation(s, window, parameters, cutoff)
    if s.predicates:
        props = {"fetchsize": str(s.fetch_size), **({"driver": s.dialect.driver} if s.dialect.driver else {}), **s.properties}
        return with_retry(lambda: spark.read.jdbc(s.url, rel, predicates=list(s.predicates), properties=props))
    r = _reader(spark, s).option("dbtable", rel)
    if s.partition_column and s.partitions > 1:
        lower, upper = (s.lower_bound, s.upper_bound) if not s.discover_bounds else discover(spark, s, rel)
        if lower is not None and upper is not None and lower != upper:
            r = r.option("partitionColumn", s.partition_column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", s.partitions)
    return with_retry(r.load)


def discover(spark: SparkSession, s: JdbcSource, rel: str) -> tuple[str | None, str | None]:
    """Bounds of the partition column within the same filters and window; a column that isn't numeric or temporal is refused."""
    c = s.dialect.quote(s.partition_column)
    row = first(spark, s, f"SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {rel}")
    if row[0] is not None and isinstance(row[0], str):
        raise JdbcError(f"partition column {s.partition_column!r} is text")
    return (None, None) if row[0] is None else (str(row[0]), str(row[1]))


def _text(v: object) -> str:
    return bytes(v).hex().upper() if isinstance(v, bytes | bytearray) else str(v)


def capture_upper(spark: SparkSession, s: JdbcSource, parameters: dict[str, str] | None = None) -> tuple[str, ...] | None:
    """The window's upper bound: the source's clock, or the greatest watermark under the same filters; None for no rows."""
    spec, d = s.watermark, s.dialect
    if s.upper_from == "SOURCE_CLOCK":
        now = with_retry(lambda: _probe(spark, s, d.clock, "q(now_ts)").first()[0], vendor=s.dialect_name)
        return (wm.render("TIMESTAMP", _text(now)),)
    rel = relation(s, None, parameters)
    names = [d.quote(c) for c in spec.columns]
    if len(names) == 1:
        row = first(spark, s, f"SELECT MAX({names[0]}) AS w0, COUNT(1) AS n FROM {rel}")
        return None if row[0] is None else (_text(row[0]),)
    whole = " AND ".join(f"{n} IS NOT NULL" for n in names)
    order = ", ".join(f"{n} DESC" for n in names)
    q = d.top1(", ".join(f"{n} AS w{i}" for i, n in enumerate(names)), f"FROM {rel} WHERE {whole} ORDER BY {order}")
    row = first(spark, s, q)
    return None if row is None else tuple(_text(v) for v in row)


def clock_drift(spark: SparkSession, s: JdbcSource) -> float:
    """Seconds the source's clock is ahead of this one; beyond ``DRIFT_SECONDS`` windows by the source's clock deserve a look."""
    d = s.dialect
    theirs = with_retry(lambda: _probe(spark, s, d.clock, "q(now_ts)").first()[0], vendor=s.dialect_name)
    own = spark.range(1).selectExpr("current_timestamp() AS t").first().t
    return (theirs - own).total_seconds()


def guard_null_watermarks(spark: SparkSession, s: JdbcSource, parameters: dict[str, str] | None = None) -> None:
    """Before a first window: rows without watermark would never be delivered (JDBC_006)."""
    names = " AND ".join(f"{s.dialect.quote(c)} IS NOT NULL" for c in s.watermark.columns)
    row = first(spark, s, f"SELECT COUNT(1) AS n, SUM(CASE WHEN {names} THEN 1 ELSE 0 END) AS known FROM {relation(s, None, parameters)}")
    if row[0] and row[0] != (row[1] or 0) and not s.allow_null_watermarks:
        raise JdbcError(f"JDBC_006 {row[0] - (row[1] or 0)} rows have no watermark")


@dataclass(frozen=True)
class Window:
    lower: tuple[str, ...] | None
    upper: tuple[str, ...] | None
    version: int | None


class IncrementalReader:
    """Bounded windows with a store; ``commit`` after the whole run, ``discard`` after a failure.

    In mode INCREMENTAL a read is the window from the stored value to the captured bound.
    In any other mode with a watermark it is the full load before the first window: while
    the store is empty, the captured bound seeds it on commit, and the load stops there
    (``bound_full_load``), so that what changes meanwhile comes with the first window and only
    with it. A store that has a value is never seeded again.
    """

    def __init__(self, spark: SparkSession, source: JdbcSource, store: wm.WatermarkStore, entity: str):
        self.spark, self.source, self.store, self.entity = spark, source, store, entity
        self.open: dict[str, Window] = {}

    def read(self, run_id: str, parameters: dict[str, str] | None = None) -> DataFrame:
        s = self.source
        known = self.store.get(self.entity)
        seeding = s.mode != "INCREMENTAL"
        if seeding and known is not None:
            self.open[run_id] = Window(known[0], None, known[1])
            return read(self.spark, s, None, parameters)
        lower, version = known if known else (None if seeding else s.initial, None)
        if known is None:
            guard_null_watermarks(self.spark, s, parameters)
        upper = capture_upper(self.spark, s, parameters)
        self.open[run_id] = Window(lower, upper, version)
        if upper is None:
            text = None if seeding else "1 = 0"
        elif seeding and (not s.bound_full_load or s.allow_null_watermarks):
            text = None
        elif lower is None:
            text = wm.upper_sql(s.watermark, upper, s.dialect.quote)
        else:
            text = wm.window_sql(s.watermark, lower, upper, s.dialect.quote)
        return read(self.spark, s, text, parameters)

    def commit(self, run_id: str) -> bool:
        """Stores the captured bound; False if it doesn't advance or there was nothing to read."""
        w = self.open.pop(run_id, None)
        if w is None:
            raise WatermarkError(f"run {run_id!r} has no open window")
        if w.upper is None:
            return False
        return self.store.advance(self.source.watermark, self.entity, w.upper, run_id, w.version)

    def discard(self, run_id: str) -> None:
        self.open.pop(run_id, None)
