"""File reading: any Spark format, several header layouts, trailers and repeated headers."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.text import normalize_header, quoted
from sluice.operators.contract import Contract, ContractError, apply_contract, enforce, fingerprint, resolve_header
from sluice.session import small_enough


@dataclass(frozen=True)
class FileFormat:
    """How files are read. Text formats are read permissively, every column as text."""

    kind: str = "csv"
    header: bool = True
    delimiter: str = ","
    quote: str = '"'
    escape: str = "\\"
    multiline: bool = False
    options: dict[str, str] = field(default_factory=dict, hash=False)


def read_files(spark: SparkSession, paths: str | list[str], fmt: FileFormat = FileFormat(), stamp: bool = True) -> DataFrame:
    """The files' rows, with ``source_file`` added if ``stamp``."""
    reader = spark.read.format(fmt.kind).option("mode", "PERMISSIVE")
    if fmt.kind == "csv":
        reader = reader.option("header", fmt.header).option("sep", fmt.delimiter).option("quote", fmt.quote).option("escape", fmt.escape)
    if fmt.kind in ("csv", "json"):
        reader = reader.option("multiLine", fmt.multiline)
    df = reader.options(**fmt.options).load(paths)
    return df.withColumn("source_file", F.col("_metadata.file_path")) if stamp else df


def map_columns(df: DataFrame, contract: Contract | None, headers: list[str] | None = None, today: str | None = None) -> DataFrame:
    """Columns under the contract's names; without contract under their normalized headers. Metadata columns stay."""
    kept = [c for c in df.columns if c == "source_file"]
    data = [c for c in df.columns if c not in kept]
    shown = headers if headers is not None else data
    if contract is None:
        names = [normalize_header(h) for h in shown]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice or "" in names:
            raise ContractError(f"HDR_003 headers collide after normalization: {', '.join(twice) or 'blank header'}")
        return df.select(*[quoted(c).alias(n) for c, n in zip(data, names, strict=True)], *kept)
    resolution = resolve_header(contract, shown, today)
    enforce(resolution.violations)
    return apply_contract(df.select(*[quoted(c) for c in data]), contract, resolution) if not kept else _with_kept(df, data, kept, contract, resolution)


def _with_kept(df, data, kept, contract, resolution):
    names = [c if c is not None else h for h, c in resolution.mapping]
    have = {n.lower() for n in names}
    extra = [F.lit(c.default).cast(c.type).alias(c.name) for c in contract.columns if not c.required and c.name.lower() not in have]
    return df.select(*[quoted(c).alias(n) for c, n in zip(data, names, strict=True)], *extra, *[quoted(k) for k in kept])


def legacy_columns(df: DataFrame, aliases: dict[str, str] | None = None, columns: list[str] = (), normalize: bool = False) -> DataFrame:
    """Columns of feeds without contract: normalized if asked, renamed by alias, then cut to a list.

    Refuses names that collide and listed columns that are missing.
    """
    by_alias = {normalize_header(a): n for a, n in (aliases or {}).items()}
    names = [by_alias.get(normalize_header(c), normalize_header(c) if normalize else c) for c in df.columns]
    lower = [n.lower() for n in names]
    twice = sorted({n for n in lower if lower.count(n) > 1})
    if twice:
        raise ContractError(f"HDR_003 columns collide: {', '.join(twice)}")
    missing = [c for c in columns if c.lower() not in lower]
    if missing:
        raise ContractError(f"HDR_001 columns are missing: {', '.join(missing)}")
    wanted = [lower.index(c.lower()) for c in columns] or range(len(names))
    return df.select(*[quoted(df.columns[i]).alias(names[i]) for i in wanted])


def union_groups(frames: list[DataFrame]) -> DataFrame:
    """Rows of frames with differing columns; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_grouped(spark: SparkSession, files: dict[str, list[str]], contract: Contract | None, fmt: FileFormat = FileFormat()) -> DataFrame:
    """Files with several header layouts in one frame: those of one layout are read together.

    ``files`` gives each path's header.
    """
    groups: dict[tuple, list[str]] = {}
    for path, header in files.items():
        key = (fingerprint(resolve_header(contract, header)), tuple(header)) if contract else (tuple(header),)
        groups.setdefault(key, []).append(path)
    return union_groups([map_columns(read_files(spark, paths, fmt), contract) for paths in groups.values()])


def without_trailer(df: DataFrame, marker: str, column: str | None = None) -> DataFrame:
    """Without rows whose first (or named) column starts with the marker, whatever its case; rows with a null there go too."""
    return df.filter(~F.lower(F.trim(quoted(column or df.columns[0]).cast("string"))).startswith(marker.lower()))


def without_repeated_headers(df: DataFrame, policy: str = "DROP") -> DataFrame:
    """Without rows that repeat the header in every column; FAIL refuses them (HDR_016)."""
    same = F.lit(True)
    for c in df.columns:
        if c != "source_file":
            same = same & F.coalesce(F.lower(F.trim(quoted(c).cast("string"))) == c.strip().lower(), F.lit(False))
    if policy == "FAIL" and not df.filter(same).isEmpty():
        raise ContractError("HDR_016 the header is repeated between the rows")
    return df.filter(~same)


def without_edges(df: DataFrame, skip_first: int = 0, drop_last: int = 0) -> DataFrame:
    """Without the first and last lines of each file.

    Lines are numbered by Spark's increasing ids, which follow file order within a file's
    parts; read files in one part each (multiLine) where they could be split. Only the
    lines to drop are ranked (each part is cut to its own first ones before the shuffle),
    so a file with most of the rows is never gathered.
    """
    if not skip_first and not drop_last:
        return df
    ided = df.withColumn("__id", F.monotonically_increasing_id())
    lines, w = ided.select("source_file", "__id"), Window.partitionBy("source_file")
    ends = [lines.withColumn("__n", F.row_number().over(w.orderBy(order))).filter(F.col("__n") <= n) for n, order in ((skip_first, F.col("__id")), (drop_last, F.col("__id").desc())) if n]
    gone = reduce(lambda a, b: a.unionByName(b), ends).select("source_file", "__id").distinct()
    return ided.join(F.broadcast(gone) if small_enough(gone) else gone, ["source_file", "__id"], "left_anti").select(*[quoted(c) for c in df.columns])
