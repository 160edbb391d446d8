"""SQL text for databases: dialects, literals, filters, templates, guardrails."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal


class SqlError(ValueError):
    """SQL that must not be sent."""


@dataclass(frozen=True)
class Dialect:
    name: str
    open: str = '"'
    close: str = '"'
    clock: str = "SELECT CURRENT_TIMESTAMP"
    limit_style: str = "LIMIT"
    probe: str = "SELECT 1"
    driver: str = ""

    def quote(self, name: str) -> str:
        """Each dotted part as a quoted identifier."""
        return ".".join(self.open + p.replace(self.close, self.close * 2) + self.close for p in name.split("."))

    def top1(self, columns: str, rest: str) -> str:
        """The first row of a SELECT whose text after the columns is ``rest``."""
        if self.limit_style == "TOP":
            return f"SELECT TOP 1 {columns} {rest}"
        return f"SELECT {columns} {rest} " + ("LIMIT 1" if self.limit_style == "LIMIT" else "FETCH FIRST 1 ROWS ONLY")


#: What the databases differ in.
DIALECTS = {
    d.name: d
    for d in (
        Dialect("generic"),
        Dialect("sqlserver", "[", "]", "SELECT SYSUTCDATETIME()", "TOP", driver="com.microsoft.sqlserver.jdbc.SQLServerDriver"),
        Dialect("postgresql", driver="org.postgresql.Driver"),
        Dialect("oracle", clock="SELECT SYSTIMESTAMP FROM DUAL", limit_style="FETCH", probe="SELECT 1 FROM DUAL", driver="oracle.jdbc.OracleDriver"),
        Dialect("db2", clock="SELECT CURRENT TIMESTAMP FROM SYSIBM.SYSDUMMY1", limit_style="FETCH", probe="SELECT 1 FROM SYSIBM.SYSDUMMY1", driver="com.ibm.db2.jcc.DB2Driver"),
        Dialect("mysql", "`", "`", driver="com.mysql.cj.jdbc.Driver"),
        Dialect("derby", clock="VALUES CURRENT_TIMESTAMP", limit_style="FETCH", probe="VALUES 1", driver="org.apache.derby.jdbc.EmbeddedDriver"),
    )
}


def dialect(name: str) -> Dialect:
    if name.lower() not in DIALECTS:
        raise SqlError(f"unknown dialect {name!r}; known: {', '.join(sorted(DIALECTS))}")
    return DIALECTS[name.lower()]


def register(d: Dialect) -> None:
    DIALECTS[d.name.lower()] = d


def literal(kind: str, value: object) -> str:
    """A typed literal; the value is read as its type first."""
    text = str(value).strip()
    try:
        if kind == "NULL" or value is None:
            return "NULL"
        if kind == "NUMBER":
            n = Decimal(text)
            if not n.is_finite():
                raise ValueError
            return str(n)
        if kind == "BOOLEAN":
            return {"true": "TRUE", "false": "FALSE"}[text.lower()]
        if kind == "DATE":
            return f"'{dt.date.fromisoformat(text)}'"
        if kind == "TIMESTAMP":
            return f"'{dt.datetime.fromisoformat(text).replace(tzinfo=None).isoformat(sep=' ')}'"
        if kind == "DATETIMEOFFSET":
            at = dt.datetime.fromisoformat(text)
            if at.tzinfo is None:
                raise ValueError
            return f"'{at.isoformat(sep=' ')}'"
    except (ArithmeticError, KeyError, ValueError) as e:
        raise SqlError(f"{value!r} is no {kind}") from e
    if kind != "STRING":
        raise SqlError(f"unknown literal type {kind!r}")
    return "'" + str(value).replace("'", "''") + "'"


OPERATORS = ("=", "!=", "<>", "<", "<=", ">", ">=", "LIKE", "IN")


@dataclass(frozen=True)
class Filter:
    """``column op value``, or a trusted expression."""

    column: str = ""
    op: str = "="
    value: object = None
    kind: str = "STRING"
    expression: str | None = None

    def render(self, d: Dialect) -> str:
        if self.expression is not None:
            return f"({self.expression})"
        op = self.op.upper()
        if op not in OPERATORS:
            raise SqlError(f"operator {self.op!r} must be one of {', '.join(OPERATORS)}")
        if op == "IN":
            values = list(self.value) if isinstance(self.value, list | tuple) else [self.value]
            if not values:
                raise SqlError("IN needs at least one value")
            return f"{d.quote(self.column)} IN ({', '.join(literal(self.kind, v) for v in values)})"
        return f"{d.quote(self.column)} {op} {literal(self.kind, self.value)}"


@dataclass(frozen=True)
class Projection:
    """A source column or expression under a target name."""

    target: str
    source: str | None = None
    expression: str | None = None

    def render(self, d: Dialect) -> str:
        if (self.source is None) == (self.expression is None):
            raise SqlError(f"column {self.target!r} needs either a source or an expression")
        return f"{d.quote(self.source) if self.source is not None else '(' + self.expression + ')'} AS {d.quote(self.target)}"


_NAME = re.compile(r"(?<![:\w]):([A-Za-z_]\w*)")


def _outside_strings(sql: str, change: Callable[[str], str]) -> str:
    """Applies ``change`` to what stands outside string literals and comments."""
    parts = re.split(r"('(?:[^']|'')*'|--[^\n]*|/\*.*?\*/)", sql, flags=re.S)
    return "".join(p if i % 2 else change(p) for i, p in enumerate(parts))


def render_template(sql: str, parameters: dict[str, str]) -> str:
    """``:name`` placeholders replaced by rendered literals; undefined and unused parameters are errors."""
    used: set[str] = set()

    def put(m: re.Match) -> str:
        if m.group(1) not in parameters:
            raise SqlError(f"parameter {m.group(1)!r} is not defined")
        used.add(m.group(1))
        return parameters[m.group(1)]

    out = _outside_strings(sql, lambda p: _NAME.sub(put, p))
    if unused := sorted(set(parameters) - used):
        raise SqlError(f"parameters not used: {', '.join(unused)}")
    return out


def single_select(sql: str) -> str:
    """The text, if it is one SELECT (or WITH) usable as a subquery."""
    text = sql.strip()
    code = _outside_strings(text, lambda p: p)
    bare = re.sub(r"'(?:[^']|'')*'|--[^\n]*|/\*.*?\*/", " ", code, flags=re.S)
    if ";" in bare:
        raise SqlError("only one statement is allowed, without a semicolon")
    if not re.match(r"\s*(SELECT|WITH)\b", bare, re.I):
        raise SqlError("only SELECT or WITH is allowed")
    depth, top = 0, []
    for ch in bare:
        depth += (ch == "(") - (ch == ")")
        top.append(ch if depth == 0 else " ")
    outer = "".join(top)
    if re.search(r"\bORDER\s+BY\b", outer, re.I) and not re.search(r"\b(TOP|OFFSET|FETCH|LIMIT)\b", outer, re.I):
        raise SqlError("a subquery can't be ordered without a limit")
    return text


def resolve_parameters(specs: dict[str, dict], context: dict[str, str], environment: dict[str, str], secrets: Callable[[str], str] | None = None) -> dict[str, str]:
    """Rendered literals from parameter specifications.

    A specification has a ``source`` (CONFIG, ENVIRONMENT, SYSTEM_PROPERTY, SECRET_PROVIDER,
    PIPELINE_PARAMETER, PROCESSING_DATE, RUN_ID, LAST_WATERMARK, UPPER_WATERMARK), a ``key`` or
    ``value``, a ``type`` and maybe a ``default``.
    """
    named = {"PROCESSING_DATE": "processing_date", "RUN_ID": "run_id", "LAST_WATERMARK": "last_watermark", "UPPER_WATERMARK": "upper_watermark"}
    out = {}
    for name, s in specs.items():
        source = s.get("source", "CONFIG").upper()
        if source == "CONFIG":
            v = s.get("value")
        elif source == "ENVIRONMENT":
            v = environment.get(s["key"])
        elif source in ("SYSTEM_PROPERTY", "PIPELINE_PARAMETER"):
            v = context.get(s["key"])
        elif source == "SECRET_PROVIDER":
            if secrets is None:
                raise SqlError(f"parameter {name!r} needs a secret provider")
            v = secrets(s["key"])
        elif source in named:
            v = context.get(named[source])
        else:
            raise SqlError(f"parameter {name!r} has unknown source {source!r}")
        v = s.get("default") if v is None else v
        if v is None:
            raise SqlError(f"parameter {name!r} has no value")
        out[name] = literal(s.get("type", "STRING").upper(), v)
    return out
