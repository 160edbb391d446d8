"""Order specifications: ``column [asc|desc] [nulls_first|nulls_last] [as <type>]``."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import quoted
from sluice.functions.types import is_type


class OrderError(ValueError):
    """A specification that can't be read, or names a missing or unorderable column."""


@dataclass(frozen=True)
class OrderTerm:
    """One term; descending with nulls last unless stated otherwise."""

    column: str
    ascending: bool = False
    nulls_first: bool = False
    kind: str | None = None
    pattern: str | None = None

    def value(self, c: Column | None = None) -> Column:
        """What is compared: the column, or its reading as the declared type (null where it can't be read)."""
        c = quoted(self.column) if c is None else c
        if self.pattern:
            return F.try_to_timestamp(c.cast("string"), F.lit(self.pattern))
        return c.try_cast(self.kind) if self.kind else c

    def sort(self) -> Column:
        v = self.value()
        if self.ascending:
            return v.asc_nulls_first() if self.nulls_first else v.asc_nulls_last()
        return v.desc_nulls_first() if self.nulls_first else v.desc_nulls_last()

    def before(self, a: Column, b: Column) -> Column:
        """Whether the raw value ``a`` strictly precedes ``b``; never null."""
        x, y = self.value(a), self.value(b)
        plain = F.coalesce(x < y if self.ascending else x > y, F.lit(False))
        null = (x.isNull() & y.isNotNull()) if self.nulls_first else (x.isNotNull() & y.isNull())
        return plain | null

    def ties(self, a: Column, b: Column) -> Column:
        return self.value(a).eqNullSafe(self.value(b))


def parse_term(text: str) -> OrderTerm:
    words = (text or "").split()
    if not words:
        raise OrderError("HDR_020 empty order specification")
    rest, kind = [w.lower() for w in words[1:]], None
    if "as" in rest:
        if rest.index("as") != len(rest) - 2:
            raise OrderError(f"HDR_020 in {text!r} 'as' needs exactly one type after it, at the end")
        kind = rest[-1]
        if not is_type(kind):
            raise OrderError(f"HDR_020 {kind!r} in {text!r} is no Spark type")
        rest = rest[:-2]
    unknown = sorted(set(rest) - {"asc", "desc", "nulls_first", "nulls_last"})
    if unknown:
        raise OrderError(f"HDR_020 unknown word(s) {', '.join(unknown)} in {text!r}")
    for both in (("asc", "desc"), ("nulls_first", "nulls_last")):
        if set(both) <= set(rest):
            raise OrderError(f"HDR_020 {text!r} has both {both[0]} and {both[1]}")
    return OrderTerm(words[0], "asc" in rest, "nulls_first" in rest, kind)


def parse_terms(text: str | list[str] | tuple[str, ...] | None) -> list[OrderTerm]:
    """Terms from a list, or from a comma-separated text; commas inside type arguments don't separate."""
    parts = re.split(r",(?![^()]*\))", text or "") if not isinstance(text, list | tuple) else list(text)
    return [parse_term(p) for p in parts if isinstance(text, list | tuple) or p.strip()]


def resolve(terms: list[OrderTerm], columns: list[str]) -> list[OrderTerm]:
    """Terms with the columns' own spelling; refuses missing columns."""
    by_lower = {c.lower(): c for c in columns}
    out = []
    for t in terms:
        if t.column.lower() not in by_lower:
            raise OrderError(f"HDR_019 order column {t.column!r} is missing")
        out.append(OrderTerm(by_lower[t.column.lower()], t.ascending, t.nulls_first, t.kind, t.pattern))
    return out


def precedes(terms: list[OrderTerm], a, b) -> Column:
    """Whether row ``a`` strictly precedes row ``b``; ``a`` and ``b`` give the column of a name."""
    out, tie = F.lit(False), F.lit(True)
    for t in terms:
        out = out | (tie & t.before(a(t.column), b(t.column)))
        tie = tie & t.ties(a(t.column), b(t.column))
    return out
