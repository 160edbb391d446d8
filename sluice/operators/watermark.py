"""Watermarks: values, their order and serialization, bounded windows, the versioned store."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import quoted

KINDS = ("TIMESTAMP", "NUMERIC", "DATE", "DATETIMEOFFSET", "ROWVERSION", "STRING")
LEGACY, HALF_OPEN = "LEGACY", "HALF_OPEN"


class WatermarkError(ValueError):
    """A value, predicate or store state that must not be used; the message starts with its code."""


@dataclass(frozen=True)
class WatermarkSpec:
    """Watermark columns with their kinds; several columns order lexicographically.

    LEGACY windows are (lower, upper], HALF_OPEN ones [lower, upper) and need one column.
    ``overlap`` widens the lower side by seconds, days or units of the first column.
    """

    columns: tuple[str, ...]
    kinds: tuple[str, ...]
    convention: str = LEGACY
    overlap: Decimal | None = None

    def __post_init__(self):
        if not self.columns or len(self.columns) != len(self.kinds):
            raise WatermarkError("JDBC_004 one kind is needed per watermark column")
        bad = [k for k in self.kinds if k not in KINDS]
        if bad:
            raise WatermarkError(f"JDBC_004 unknown watermark kind {bad[0]!r}")
        if self.convention not in (LEGACY, HALF_OPEN):
            raise WatermarkError(f"JDBC_004 unknown boundary convention {self.convention!r}")
        if self.convention == HALF_OPEN and len(self.columns) > 1:
            raise WatermarkError("JDBC_004 half-open windows need a single column")


def serialize(values: list[str] | tuple[str, ...]) -> str:
    """Parts joined by ``|``; both ``|`` and the backslash are escaped by a backslash."""
    return "|".join(re.sub(r"([\\|])", r"\\\1", v) for v in values)


def deserialize(text: str) -> tuple[str, ...]:
    out, part, escaped = [], "", False
    for ch in text:
        if escaped:
            part, escaped = part + ch, False
        elif ch == "\\":
            escaped = True
        elif ch == "|":
            out.append(part)
            part = ""
        else:
            part += ch
    return (*out, part + "\\" * escaped)


_STAMP = re.compile(r"(\d{4}-\d{1,2}-\d{1,2})[ T](\d{1,2}:\d{2}:\d{2})(?:\.(\d{1,9}))?\s*(Z|[+-]\d{2}:?\d{2})?")


def _stamp(text: str, zoned: bool) -> tuple[dt.datetime, int, dt.timedelta]:
    """(seconds part, nanoseconds, offset)."""
    m = _STAMP.fullmatch(text.strip())
    if not m or zoned != bool(m.group(4)):
        raise WatermarkError(f"JDBC_004 {text!r} is no {'timestamp with offset' if zoned else 'timestamp'}")
    try:
        at = dt.datetime.strptime(f"{m.group(1)} {m.group(2)}", "%Y-%m-%d %H:%M:%S")
    except ValueError as e:
        raise WatermarkError(f"JDBC_004 {text!r} is no point in time") from e
    offset = dt.timedelta()
    if m.group(4) and m.group(4) != "Z":
        sign = -1 if m.group(4)[0] == "-" else 1
        offset = sign * dt.timedelta(hours=int(m.group(4)[1:3]), minutes=int(m.group(4)[-2:]))
    return at, int((m.group(3) or "").ljust(9, "0")), offset


def parse(kind: str, text: str):
    """A value that compares in the kind's order; refuses what isn't of the kind."""
    t = text.strip()
    if kind == "NUMERIC":
        try:
            n = Decimal(t)
        except InvalidOperation as e:
            raise WatermarkError(f"JDBC_004 {text!r} is no number") from e
        if not n.is_finite():
            raise WatermarkError(f"JDBC_004 {text!r} is no number")
        return n
    if kind == "DATE":
        try:
            return dt.date.fromisoformat(t) if re.fullmatch(r"\d{4}-\d{2}-\d{2}", t) else dt.date.fromisoformat("")
        except ValueError as e:
            raise WatermarkError(f"JDBC_004 {text!r} is no date") from e
    if kind == "TIMESTAMP":
        at, nanos, _ = _stamp(t, False)
        return at, nanos
    if kind == "DATETIMEOFFSET":
        at, nanos, offset = _stamp(t, True)
        return at - offset, nanos
    if kind == "ROWVERSION":
        m = re.fullmatch(r"(?:0[xX])?([0-9A-Fa-f]{1,16})", t)
        if not m:
            raise WatermarkError(f"JDBC_004 {text!r} is no row version")
        return int(m.group(1), 16)
    return text


def compare(spec: WatermarkSpec, a: tuple[str, ...], b: tuple[str, ...]) -> int:
    x = [parse(k, v) for k, v in zip(spec.kinds, a, strict=True)]
    y = [parse(k, v) for k, v in zip(spec.kinds, b, strict=True)]
    return (x > y) - (x < y)


def later(spec: WatermarkSpec, a: tuple[str, ...], b: tuple[str, ...]) -> tuple[str, ...]:
    """The later of two values, so that a watermark never moves back."""
    return a if compare(spec, a, b) >= 0 else b


def _fraction(nanos: int, least: int = 1) -> str:
    return f"{nanos:09d}".rstrip("0").ljust(least, "0")


def render(kind: str, text: str) -> str:
    """The canonical text of a value."""
    v = parse(kind, text)
    if kind == "TIMESTAMP":
        return f"{v[0]:%Y-%m-%d %H:%M:%S}.{_fraction(v[1])}"
    if kind == "DATETIMEOFFSET":
        at, nanos, offset = _stamp(text.strip(), True)
        minutes = int(offset.total_seconds() // 60)
        return f"{at:%Y-%m-%d %H:%M:%S}.{nanos // 100:07d} {'-' if minutes < 0 else '+'}{abs(minutes) // 60:02d}:{abs(minutes) % 60:02d}"
    if kind == "ROWVERSION":
        return f"{v:016X}"
    return str(v) if kind != "STRING" else text


def overlapped(kind: str, text: str, amount: Decimal | None) -> str:
    """The value moved back by the overlap; wall-clock arithmetic, so no zone can shift it."""
    if amount is None:
        return text
    v = parse(kind, text)
    if kind == "NUMERIC":
        return str(v - Decimal(amount))
    if kind == "DATE":
        return str(v - dt.timedelta(days=int(amount)))
    if kind == "ROWVERSION":
        return f"{max(0, v - int(amount)):016X}"
    if kind == "STRING":
        raise WatermarkError("JDBC_004 text has no overlap arithmetic")
    at, nanos, offset = _stamp(text.strip(), kind == "DATETIMEOFFSET")
    total = nanos - int(Decimal(amount) * 1_000_000_000)
    moved = at + dt.timedelta(seconds=total // 1_000_000_000)
    back = f"{moved:%Y-%m-%d %H:%M:%S}.{_fraction(total % 1_000_000_000)}"
    if kind == "TIMESTAMP":
        return back
    minutes = int(offset.total_seconds() // 60)
    return render(kind, f"{back} {'-' if minutes < 0 else '+'}{abs(minutes) // 60:02d}:{abs(minutes) % 60:02d}")


def literal(kind: str, text: str) -> str:
    """The value as a SQL literal; it is parsed first, so stored rubbish can't become SQL."""
    if kind == "STRING":
        return "'" + text.replace("'", "''") + "'"
    shown = render(kind, text)
    return {"NUMERIC": shown, "ROWVERSION": "0x" + shown}.get(kind, f"'{shown}'")


def predicate_sql(spec: WatermarkSpec, value: tuple[str, ...], quote=lambda c: c, overlap: bool = True) -> str:
    """Rows after ``value`` (or from it on, for HALF_OPEN) as SQL text."""
    if len(value) != len(spec.columns):
        raise WatermarkError(f"JDBC_004 the watermark has {len(value)} parts, {len(spec.columns)} are needed")
    v = list(value)
    if overlap:
        v[0] = overlapped(spec.kinds[0], v[0], spec.overlap)
    shown = [literal(k, x) for k, x in zip(spec.kinds, v, strict=True)]
    names = [quote(c) for c in spec.columns]
    if len(names) == 1:
        return f"{names[0]} {'>=' if spec.convention == HALF_OPEN else '>'} {shown[0]}"
    steps = [" AND ".join([*(f"{names[j]} = {shown[j]}" for j in range(i)), f"{names[i]} > {shown[i]}"]) for i in range(len(names))]
    return "(" + " OR ".join(f"({s})" for s in steps) + ")"


def window_sql(spec: WatermarkSpec, lower: tuple[str, ...], upper: tuple[str, ...], quote=lambda c: c) -> str:
    return f"({predicate_sql(spec, lower, quote)}) AND NOT ({predicate_sql(spec, upper, quote, overlap=False)})"


def upper_sql(spec: WatermarkSpec, upper: tuple[str, ...], quote=lambda c: c) -> str:
    return f"NOT ({predicate_sql(spec, upper, quote, overlap=False)})"


def _typed(kind: str, text: str) -> Column:
    if kind == "ROWVERSION":
        return F.unhex(F.lit(render(kind, text)))
    to = {"NUMERIC": "decimal(38,10)", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "DATETIMEOFFSET": "timestamp", "STRING": "string"}[kind]
    return F.lit(render(kind, text)).cast(to)


def after(spec: WatermarkSpec, value: tuple[str, ...], overlap: bool = True) -> Column:
    """The same predicate on a DataFrame; comparisons with literals, so scans can use them."""
    v = list(value)
    if overlap:
        v[0] = overlapped(spec.kinds[0], v[0], spec.overlap)
    if len(v) == 1:
        c, x = quoted(spec.columns[0]), _typed(spec.kinds[0], v[0])
        return c >= x if spec.convention == HALF_OPEN else c > x
    out = F.lit(False)
    for i in range(len(v)):
        one = quoted(spec.columns[i]) > _typed(spec.kinds[i], v[i])
        for j in range(i):
            one = (quoted(spec.columns[j]) == _typed(spec.kinds[j], v[j])) & one
        out = out | one
    return out


def window(df: DataFrame, spec: WatermarkSpec, lower: tuple[str, ...] | None, upper: tuple[str, ...]) -> DataFrame:
    """Rows of the bounded window; without a lower value everything up to the upper one. Null watermarks are in no window."""
    rows = df.filter(~after(spec, upper, overlap=False))
    return rows if lower is None else rows.filter(after(spec, lower))


def highest(df: DataFrame, spec: WatermarkSpec) -> DataFrame:
    """One row with the highest watermark among rows without nulls in it; no row for none."""
    whole = F.lit(True)
    for c in spec.columns:
        whole = whole & quoted(c).isNotNull()
    return df.filter(whole).agg(F.max(F.struct(*[quoted(c).alias(c) for c in spec.columns])).alias("m")).filter("m IS NOT NULL").select("m.*")


def null_watermarks(df: DataFrame, spec: WatermarkSpec) -> DataFrame:
    """One row: all rows and those without a whole watermark, which no window would ever deliver."""
    missing = F.lit(False)
    for c in spec.columns:
        missing = missing | quoted(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(missing.cast("bigint")), F.lit(0)).alias("n_null"))


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Least and greatest value of a column, to cut a read into ranges."""
    return df.agg(F.min(quoted(column)).alias("lower"), F.max(quoted(column)).alias("upper"))


STORE_SCHEMA = "entity string, watermark_value string, run_id string, watermark_version bigint, lower_value string, query_hash string, updated_ts timestamp"


def latest_version(history: DataFrame) -> DataFrame:
    """Per entity the newest version of its watermark and how often that version exists (more than 1: two writers)."""
    top = history.groupBy("entity").agg(F.max("watermark_version").alias("watermark_version"))
    same = history.join(top, ["entity", "watermark_version"])
    return same.groupBy("entity", "watermark_version").agg(F.max(F.struct("updated_ts", "watermark_value")).alias("m"), F.count(F.lit(1)).alias("n_writers")).select("entity", "watermark_version", F.col("m.watermark_value").alias("watermark_value"), "n_writers")


class WatermarkStore:
    """Append-only history per entity; a new value names the version it follows.

    ``table`` reads and appends through the two functions given, so any table will do.
    """

    def __init__(self, read, append):
        self._read, self._append = read, append

    def get(self, entity: str) -> tuple[tuple[str, ...], int] | None:
        got = latest_version(self._read().filter(F.col("entity") == entity)).first()
        if got is None:
            return None
        if got.n_writers > 1:
            raise WatermarkError(f"JDBC_005 version {got.watermark_version} of {entity} was written {got.n_writers} times")
        return deserialize(got.watermark_value), got.watermark_version

    def advance(self, spec: WatermarkSpec, entity: str, value: tuple[str, ...], run_id: str, expected: int | None, query_hash: str = "") -> bool:
        """Stores ``value`` if it is later than the stored one; False if it isn't. Refuses if the stored version isn't the expected one."""
        now = self.get(entity)
        if (now[1] if now else None) != expected:
            raise WatermarkError(f"JDBC_005 watermark of {entity} is at version {now and now[1]}, expected {expected}")
        if now and compare(spec, value, now[0]) <= 0:
            return False
        self._append((entity, serialize(value), run_id, (expected or 0) + 1, serialize(now[0]) if now else "", query_hash, dt.datetime.now(dt.UTC).replace(tzinfo=None)))
        self.get(entity)
        return True
