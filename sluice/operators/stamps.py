"""Columns stamped on rows: landing metadata, lineage, hashes, audit columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.hashing import file_id, key_hash, key_json, record_hash
from sluice.functions.text import quoted

#: Column vocabularies.
RAW_COLUMNS = ("source_file", "row_idx", "load_timestamp", "file_type", "file_id")
LINEAGE_COLUMNS = ("run_id", "source_system", "source_database", "source_schema", "source_table", "extract_start_ts", "extract_end_ts")
EXTENDED_COLUMNS = ("source_modified_ts", "source_operation", "source_primary_key", "source_primary_key_json")
TECHNICAL_COLUMNS = ("kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "kafka_tombstone", "source_file_modified_ts", "source_record_number", "source_sequence_number")
NO_CONTENT = {*RAW_COLUMNS, *LINEAGE_COLUMNS, *EXTENDED_COLUMNS, *TECHNICAL_COLUMNS, "record_hash", "ingest_dt"}


class StampError(ValueError):
    """A stamp that would overwrite or lose data; the message starts with its code."""


@dataclass(frozen=True)
class Lineage:
    """Where a batch comes from; empty strings where unknown."""

    run_id: str
    source_system: str = ""
    source_database: str = ""
    source_schema: str = ""
    source_table: str = ""
    extract_start_ts: str = ""
    extract_end_ts: str = ""


def _refuse_collisions(df: DataFrame, names: tuple[str, ...]) -> None:
    clash = sorted({c for c in df.columns} & set(names) | {c for c in df.columns if c.lower() in names})
    if clash:
        raise StampError(f"RAW_003 the source has columns reserved for metadata: {', '.join(clash)}")


def stamp_raw(df: DataFrame, file_type: str, lineage: Lineage | None = None, source_file: Column | None = None, loaded_at: Column | None = None) -> DataFrame:
    """Adds the landing metadata, and the lineage if given, in one projection.

    ``source_file`` is the row's file or the given expression, ``row_idx`` increases within a
    file part but has gaps. A ``source_file`` the reader stamped is kept; any other reserved name is an error.
    """
    stamped = "source_file" in df.columns
    _refuse_collisions(df.drop("source_file") if stamped else df, RAW_COLUMNS + (LINEAGE_COLUMNS if lineage else ()))
    origin = F.col("source_file") if stamped else (source_file if source_file is not None else F.input_file_name())
    out = {
        "source_file": origin,
        "row_idx": F.monotonically_increasing_id(),
        "load_timestamp": loaded_at if loaded_at is not None else F.current_timestamp(),
        "file_type": F.lit(file_type),
        "file_id": file_id(origin),
    }
    if lineage:
        out |= {c: F.lit(getattr(lineage, c)) for c in LINEAGE_COLUMNS}
    return df.withColumns(out)


def stamp_extended(df: DataFrame, keys: list[str], modified: str | None = None, delete_indicator: str | None = None, delete_values: tuple[str, ...] = ("true", "1", "y", "d")) -> DataFrame:
    """Adds the modification time, the operation (D or UPSERT), and the key as hash and JSON."""
    _refuse_collisions(df, EXTENDED_COLUMNS)
    dead = F.coalesce(F.lower(F.trim(quoted(delete_indicator).cast("string"))).isin(*delete_values), F.lit(False)) if delete_indicator else F.lit(False)
    return df.withColumns(
        {
            "source_modified_ts": quoted(modified).cast("string") if modified else F.lit(None).cast("string"),
            "source_operation": F.when(dead, "D").otherwise("UPSERT"),
            "source_primary_key": key_hash(keys) if keys else F.lit(None).cast("string"),
            "source_primary_key_json": key_json(keys) if keys else F.lit(None).cast("string"),
        }
    )


def content_columns(df: DataFrame) -> list[str]:
    """Columns that carry content rather than metadata."""
    return [c for c in df.columns if c.lower() not in NO_CONTENT]


def stamp_hash(df: DataFrame, columns: list[str] | None = None, trim: bool = False, upper: bool = False) -> DataFrame:
    return df.withColumn("record_hash", record_hash(content_columns(df) if columns is None else columns, trim, upper))


def stamp_audit(df: DataFrame, at: Column | None = None, run_id: str | None = None) -> DataFrame:
    """Adds the audit columns that are absent; the run is stamped only where its column exists."""
    have = {c.lower() for c in df.columns}
    now = at if at is not None else F.current_timestamp()
    out = {c: v for c, v in (("create_timestamp", now), ("last_modified_ts", now), ("last_modified_op", F.lit("I"))) if c not in have}
    if run_id is not None and "last_modified_run_id" in have:
        out["last_modified_run_id"] = F.lit(run_id)
    return df.withColumns(out) if out else df


def drop_technical(df: DataFrame, retain: bool = False, needed: list[str] = ()) -> DataFrame:
    """Without the technical source columns; refuses if one of them is needed later."""
    gone = [] if retain else [c for c in df.columns if c.lower() in TECHNICAL_COLUMNS]
    used = [c for c in gone if c.lower() in {n.lower() for n in needed}]
    if used:
        raise StampError(f"CUR_007 technical columns in use can't be dropped: {', '.join(used)}; retain them")
    return df.drop(*gone)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts the named columns that exist, in one projection; what can't be read becomes null."""
    have = {c.lower(): c for c in df.columns}
    out = {have[c.lower()]: quoted(have[c.lower()]).try_cast(t) for c, t in types.items() if c.lower() in have}
    return df.withColumns(out) if out else df


def contract_transforms(df: DataFrame, transforms: dict[str, str]) -> DataFrame:
    """TRIM, UPPER, LOWER or an expression with ``{col}`` per column; all see the values before any of them."""
    have = {c.lower(): c for c in df.columns}
    simple = {"TRIM": F.trim, "UPPER": F.upper, "LOWER": F.lower}
    out = {}
    for name, how in transforms.items():
        c = have.get(name.lower())
        if c is not None:
            out[c] = simple[how.upper()](quoted(c)) if how.upper() in simple else F.expr(how.replace("{col}", "`" + c.replace("`", "``") + "`"))
    return df.withColumns(out) if out else df


def derive(df: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    """Derived columns in order; each sees the earlier ones."""
    for name, expression in steps:
        df = df.withColumn(name, F.expr(expression))
    return df


def derive_partitions(df: DataFrame, rules: dict[str, str | dict]) -> DataFrame:
    """Partition columns from expressions, or literals given as ``{"literal": value}``."""
    return df.withColumns({k: F.lit(v["literal"]) if isinstance(v, dict) and "literal" in v else F.expr(v["expr"] if isinstance(v, dict) else v) for k, v in rules.items()})
