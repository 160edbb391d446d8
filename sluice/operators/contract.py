"""Schema contracts: which columns a feed has, and what a header that differs means."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.text import normalize_header, quoted
from sluice.functions.types import is_type
from sluice.operators.validate import ContentRule, null_counts

STRATEGIES = ("NAME_ALIAS", "STRICT_NAME", "POSITION", "NAME_ALIAS_POSITION_FALLBACK")
#: What happens by default for each kind of violation, and its code.
VIOLATIONS = {
    "missing_required": ("HDR_001", "FAIL"),
    "duplicate_header": ("HDR_002", "FAIL"),
    "duplicate_normalized": ("HDR_003", "FAIL"),
    "ambiguous_mapping": ("HDR_005", "FAIL"),
    "unexpected_column": ("HDR_006", "WARN"),
    "column_count": ("HDR_007", "FAIL"),
    "delimiter_mismatch": ("HDR_009", "FAIL"),
    "blank_header": ("HDR_010", "FAIL"),
    "malformed_header": ("HDR_011", "FAIL"),
    "encoding": ("HDR_012", "FAIL"),
    "header_only": ("HDR_013", "WARN_AND_SKIP"),
    "version": ("HDR_014", "WARN"),
    "content": ("HDR_015", "FAIL"),
    "repeated_header": ("HDR_016", "FAIL"),
    "type_change": ("type_change", "FAIL"),
    "order_change": ("order_change", "WARN"),
    "nullability": ("nullability_violation", "FAIL"),
}


class ContractError(ValueError):
    """A contract that contradicts itself, or a header or frame that breaks it."""


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str = "string"
    nullable: bool = True
    aliases: tuple[str, ...] = ()
    position: int | None = None
    required: bool = True
    default: str | None = None
    category: str = "BUSINESS"
    rule: ContentRule | None = None
    transform: str | None = None
    sensitive: bool = False
    business_key: bool = False
    alias_windows: dict[str, tuple[str | None, str | None]] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Violation:
    kind: str
    code: str
    message: str
    policy: str


@dataclass(frozen=True)
class Contract:
    """A versioned set of columns. Names and aliases must differ after normalization."""

    columns: tuple[ContractColumn, ...]
    strategy: str = "NAME_ALIAS"
    version: str = "1"
    compatibility: str = "BACKWARD"
    policies: dict[str, str] = field(default_factory=dict, hash=False)

    def __post_init__(self):
        if self.strategy not in STRATEGIES:
            raise ContractError(f"HDR_017 strategy {self.strategy!r} must be one of {', '.join(STRATEGIES)}")
        owner: dict[str, str] = {}
        for c in self.columns:
            if not is_type(c.type):
                raise ContractError(f"HDR_017 column {c.name!r} has no Spark type: {c.type!r}")
            for n in (c.name, *c.aliases):
                key = normalize_header(n)
                if not key:
                    raise ContractError(f"HDR_017 {n!r} of column {c.name!r} has no letter or digit")
                if owner.setdefault(key, c.name) != c.name:
                    raise ContractError(f"HDR_017 {n!r} names both {owner[key]!r} and {c.name!r}")
        at = [c.position for c in self.columns if c.position is not None]
        if self.strategy in ("POSITION", "NAME_ALIAS_POSITION_FALLBACK") and sorted(at) != list(range(len(self.columns))):
            raise ContractError("HDR_008 positions must be 0 to n-1 without gaps")

    @property
    def business_keys(self) -> list[str]:
        return [c.name for c in self.columns if c.business_key]

    @property
    def rules(self) -> dict[str, ContentRule]:
        return {c.name: c.rule for c in self.columns if c.rule}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T.DataType.fromDDL(c.type), c.nullable) for c in self.columns])

    def lookup(self, today: str | None = None) -> dict[str, ContractColumn]:
        """Column by normalized name; aliases outside their period are left out, all of them under STRICT_NAME."""
        out = {normalize_header(c.name): c for c in self.columns}
        if self.strategy != "STRICT_NAME":
            for c in self.columns:
                for a in c.aliases:
                    start, end = c.alias_windows.get(a, (None, None))
                    if today is None or ((start is None or start <= today) and (end is None or today <= end)):
                        out.setdefault(normalize_header(a), c)
        return out

    def policy(self, kind: str) -> str:
        return self.policies.get(kind, VIOLATIONS[kind][1])

    def violation(self, kind: str, message: str) -> Violation:
        return Violation(kind, VIOLATIONS[kind][0], message, self.policy(kind))


@dataclass(frozen=True)
class Resolution:
    """Header to column name, in header order; None where no column is meant."""

    mapping: tuple[tuple[str, str | None], ...]
    violations: tuple[Violation, ...]
    by_position: bool = False

    @property
    def renames(self) -> dict[str, str]:
        return {h: c for h, c in self.mapping if c is not None}


def resolve_header(contract: Contract, headers: list[str], today: str | None = None) -> Resolution:
    """Maps a header to the contract and lists every violation found."""
    known, out = contract.lookup(today), []
    seen: dict[str, int] = {}
    for h in headers:
        seen[h] = seen.get(h, 0) + 1
    out += [contract.violation("duplicate_header", f"header {h!r} occurs {n} times") for h, n in seen.items() if n > 1]
    normal: dict[str, list[str]] = {}
    for h in dict.fromkeys(headers):
        normal.setdefault(normalize_header(h), []).append(h)
    out += [contract.violation("blank_header", f"header {h!r} has no letter or digit") for h in normal.get("", [])]
    out += [contract.violation("duplicate_normalized", f"headers {', '.join(map(repr, hs))} are the same") for n, hs in normal.items() if len(hs) > 1 and n]
    by_position = contract.strategy == "POSITION"
    mapping = [(h, known[normalize_header(h)].name if normalize_header(h) in known else None) for h in headers]
    found = {c for _, c in mapping if c}
    missing = [c.name for c in contract.columns if c.required and c.name not in found]
    if contract.strategy == "NAME_ALIAS_POSITION_FALLBACK" and missing:
        by_position = True
    if by_position:
        if len(headers) != len(contract.columns):
            out.append(contract.violation("column_count", f"{len(headers)} columns, {len(contract.columns)} expected"))
            return Resolution(tuple((h, None) for h in headers), tuple(out), True)
        ordered = sorted(contract.columns, key=lambda c: c.position)
        return Resolution(tuple((h, c.name) for h, c in zip(headers, ordered, strict=True)), tuple(out), True)
    sources: dict[str, list[str]] = {}
    for h, c in mapping:
        if c:
            sources.setdefault(c, []).append(h)
    out += [contract.violation("ambiguous_mapping", f"{', '.join(map(repr, hs))} all mean {c!r}") for c, hs in sources.items() if len(set(hs)) > 1]
    out += [contract.violation("missing_required", f"required column {c!r} is missing") for c in missing]
    out += [contract.violation("unexpected_column", f"unexpected column {h!r}") for h, c in mapping if c is None and normalize_header(h)]
    expected = [c.name for c in sorted(contract.columns, key=lambda c: (c.position is None, c.position)) if c.name in found and c.position is not None]
    actual = [c for _, c in mapping if c in expected]
    if actual != expected and set(actual) == set(expected):
        out.append(contract.violation("order_change", f"columns come as {', '.join(actual)}"))
    return Resolution(tuple(mapping), tuple(out))


def header_violations(headers: DataFrame, contracts: dict[str, Contract], identity: str, entity: str, header: str) -> DataFrame:
    """(identity, kind, code, message): every violation of every comma-joined header against its entity's contract.

    Checked where the headers lie; the contracts are configuration and go to every task.
    Null headers and entities without contract give no row.
    """
    kind = headers.schema[identity].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, e, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if text is not None and e in contracts:
                    rows += [(i, v.kind, v.code, v.message) for v in resolve_header(contracts[e], text.split(",")).violations]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, b.schema.field(0).type if k == 0 else pa.string()) for k, x in enumerate(zip(*rows, strict=True))], [identity, "kind", "code", "message"])

    return headers.select(identity, entity, header).mapInArrow(check, f"`{identity}` {kind}, kind string, code string, message string")


def enforce(violations: list[Violation] | tuple[Violation, ...]) -> list[Violation]:
    """Raises one error with all violations whose policy is FAIL; returns the others that aren't ignored."""
    bad = [v for v in violations if v.policy == "FAIL"]
    if bad:
        raise ContractError("; ".join(f"{v.code} {v.message}" for v in bad))
    return [v for v in violations if v.policy != "IGNORE"]


def apply_contract(df: DataFrame, contract: Contract, resolution: Resolution) -> DataFrame:
    """Renames to the contract's names and adds absent optional columns, in one projection. Extra columns stay."""
    names = [c if c is not None else h for h, c in resolution.mapping]
    renamed = df.toDF(*names) if names != df.columns else df
    have = {n.lower() for n in names}
    missing = {c.name: F.lit(c.default).cast(c.type) for c in contract.columns if not c.required and c.name.lower() not in have}
    return renamed.withColumns(missing) if missing else renamed


def explain(contract: Contract, resolution: Resolution) -> list[tuple[str, str, str]]:
    """(header, column, EXACT | ALIAS | POSITION | UNEXPECTED) for each header."""
    out = []
    for h, c in resolution.mapping:
        kind = "UNEXPECTED" if c is None else "POSITION" if resolution.by_position else "EXACT" if normalize_header(h) == normalize_header(c) else "ALIAS"
        out.append((h, c or "", kind))
    return out


def fingerprint(resolution: Resolution) -> str:
    """SHA-256 of the header as column names; equal for files that can be read together."""
    return hashlib.sha256("\u0001".join(c or normalize_header(h) for h, c in resolution.mapping).encode()).hexdigest()


def type_changes(contract: Contract, df: DataFrame) -> list[Violation]:
    """Columns whose type isn't the contract's; text sources fit every type."""
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    return [contract.violation("type_change", f"column {c.name!r} is {k.simpleString()}, not {c.type}") for c in contract.columns if (k := kinds.get(c.name.lower())) and not isinstance(k, T.StringType) and k != T.DataType.fromDDL(c.type)]


def null_violations(contract: Contract, df: DataFrame) -> list[Violation]:
    """Columns that must not be null and are, by one aggregate."""
    have = {c.lower() for c in df.columns}
    cols = [c.name for c in contract.columns if not c.nullable and c.name.lower() in have]
    return [contract.violation("nullability", f"column {r.column_name!r} has {r.n_null} nulls") for r in null_counts(df, cols).collect() if r.n_null] if cols else []


def version_violations(contract: Contract, recorded: dict[str, str]) -> list[Violation]:
    """Against what a table's properties record: another version, or a break of backward compatibility."""
    out = []
    before = recorded.get("ingest.schema.version")
    if before is not None and before != contract.version:
        out.append(contract.violation("version", f"table has schema version {before}, contract {contract.version}"))
    old = {c for c in recorded.get("ingest.schema.required", "").split(",") if c}
    now = {c.name for c in contract.columns if c.required}
    if before is not None and contract.compatibility == "BACKWARD" and now - old:
        out.append(contract.violation("version", f"newly required: {', '.join(sorted(now - old))}"))
    return out


def recorded_properties(contract: Contract) -> dict[str, str]:
    return {"ingest.schema.version": contract.version, "ingest.schema.required": ",".join(sorted(c.name for c in contract.columns if c.required))}


def curated_gate(df: DataFrame, contract: Contract, keys: list[str], order: list[str]) -> list[Violation]:
    """Before publishing: required columns there and not all null, names unique, keys and order columns there."""
    lower = [c.lower() for c in df.columns]
    bad = [f"required column {c.name!r} is missing" for c in contract.columns if c.required and c.category == "BUSINESS" and c.name.lower() not in lower]
    bad += [f"column {c!r} occurs twice" for c in sorted({c for c in lower if lower.count(c) > 1})]
    bad += [f"key column {k!r} is missing" for k in keys if k.lower() not in lower]
    bad += [f"order column {o!r} is missing" for o in order if o.lower() not in lower]
    here = [c.name for c in contract.columns if c.required and c.name.lower() in lower]
    if not bad and here:
        bad += [f"required column {r.column_name!r} has no value" for r in null_counts(df.select(*[quoted(c) for c in here]), here).collect() if r.n_rows and r.n_null == r.n_rows]
    return [Violation("curated_gate", "HDR_018", m, "FAIL") for m in bad]
