"""Freshness-compared upsert of a batch into a current-state table.

``merge`` is a pure function of two DataFrames. Both meet in one full outer join on
null-safe keys, which reads each once. Where the target is a stored table much larger
than a broadcast may be and the batch is measured to be small, the batch is written
once and joined to the target where the target lies, so untouched rows are never
shuffled; which keys are new takes a second scan of the target's key columns alone.
Each output row carries its outcome, so all counters come from one aggregate. No keyed
operator stands above a union.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.order import OrderTerm, parse_terms, precedes, resolve
from sluice.functions.text import quoted
from sluice.operators.keys import latest_per_key, split_blank_keys, unchecked_casts
from sluice.session import BROADCAST_BYTE_CAP, cut, prepare, small_enough, stored_bytes

#: What a soft-delete indicator may say.
DELETE_VALUES = ("true", "1", "y", "d")
INSERTED, UPDATED, DELETED, IGNORED, UNCHANGED, PASSED, ABSENT = "inserted", "updated", "deleted", "ignored", "unchanged", "passthrough", "absent"
OUTCOME = "_outcome"
#: A target of so many times the broadcast cap is worth a second scan of its keys rather than a shuffle of its rows.
LARGE_TARGET = 8


class MergeError(ValueError):
    """A merge that would lose or confuse rows; the message starts with its code."""


@dataclass(frozen=True)
class MergeSpec:
    """How rows of one key compete.

    ``freshness`` and ``tie_breakers`` decide (``strategy`` FRESHNESS); the target wins full
    ties. With LAST_WRITE_WINS the batch always wins, which has to be allowed. If both
    sides have ``hash_column``, live rows with the target's hash are no change; a strictly
    newer one only advances the version columns. ``deletes`` is IGNORE, SOFT or
    FULL_SNAPSHOT_ABSENCE.
    """

    keys: tuple[str, ...]
    freshness: str | None = None
    compare_as: str | None = None
    compare_format: str | None = None
    tie_breakers: tuple[str, ...] = ()
    strategy: str = "FRESHNESS"
    allow_last_write_wins: bool = False
    hash_column: str = "record_hash"
    deletes: str = "IGNORE"
    indicator: str | None = None
    indicator_values: tuple[str, ...] = DELETE_VALUES
    confirm_complete_extract: bool = False
    partition_columns: tuple[str, ...] = field(default=())

    def __post_init__(self):
        if self.strategy not in ("FRESHNESS", "LAST_WRITE_WINS"):
            raise MergeError(f"CUR_008 strategy {self.strategy!r} must be FRESHNESS or LAST_WRITE_WINS")
        if self.strategy == "LAST_WRITE_WINS" and not self.allow_last_write_wins:
            raise MergeError("CUR_008 LAST_WRITE_WINS lets late older rows win; allow_last_write_wins must be set")
        if self.strategy == "FRESHNESS" and not self.freshness and self.deletes != "FULL_SNAPSHOT_ABSENCE":
            raise MergeError("CUR_008 the freshness merge needs a freshness column")
        if self.deletes in ("CHANGE_TRACKING", "CDC", "RECONCILE", "PERIODIC_KEY_RECONCILIATION"):
            raise MergeError(f"CUR_005 deletes mode {self.deletes} isn't available")
        if self.deletes not in ("IGNORE", "SOFT", "FULL_SNAPSHOT_ABSENCE"):
            raise MergeError(f"deletes mode {self.deletes!r} must be IGNORE, SOFT or FULL_SNAPSHOT_ABSENCE")
        if self.deletes == "SOFT" and not self.indicator:
            raise MergeError("deletes mode SOFT needs an indicator column")
        if self.deletes == "FULL_SNAPSHOT_ABSENCE" and not self.confirm_complete_extract:
            raise MergeError("CUR_005 absence only means deletion if the extract is complete: confirm_complete_extract must be set")

    def terms(self) -> list[OrderTerm]:
        if self.strategy != "FRESHNESS" or not self.freshness:
            return []
        return [OrderTerm(self.freshness, kind=None if self.compare_format else self.compare_as, pattern=self.compare_format), *parse_terms(self.tie_breakers)]


def resolve_keys(configured: list[str] | None, business_keys: list[str]) -> list[str]:
    """Merge keys from configuration or contract; an explicit empty list means none; a contradiction is an error."""
    if configured is None:
        return list(business_keys)
    if configured and business_keys and {c.lower() for c in configured} != {c.lower() for c in business_keys}:
        raise MergeError(f"HDR_017 merge keys {configured} contradict the contract's business keys {business_keys}")
    return list(configured)


def resolve_publish_mode(configured: str | None, incremental: bool, exists: bool, partition_columns: tuple[str, ...], keys: tuple[str, ...], deletes: str = "IGNORE") -> str:
    """MERGE, PARTITION_OVERWRITE or FULL_OVERWRITE.

    Unset, an incremental batch into an existing table merges, everything else replaces. A scoped
    overwrite needs partition columns and keys, can't prove absence, and starts with a full build.
    """
    if configured is None:
        return "MERGE" if incremental and exists else "FULL_OVERWRITE"
    mode = configured.upper()
    if mode not in ("MERGE", "PARTITION_OVERWRITE", "FULL_OVERWRITE"):
        raise MergeError(f"publish mode {configured!r} must be MERGE, PARTITION_OVERWRITE or FULL_OVERWRITE")
    if mode == "PARTITION_OVERWRITE":
        if not partition_columns or not keys:
            raise MergeError("CUR_006 PARTITION_OVERWRITE needs partition columns and merge keys")
        if deletes == "FULL_SNAPSHOT_ABSENCE":
            raise MergeError("CUR_006 part of a table can't prove a key absent")
        if not exists:
            return "FULL_OVERWRITE"
    return mode


def is_tombstone(spec: MergeSpec, c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*[v.lower() for v in spec.indicator_values]), F.lit(False))


def align(df: DataFrame, schema: T.StructType, defaults: dict[str, object] | None = None, required: tuple[str, ...] = ()) -> DataFrame:
    """The target's columns in its order and types, in one projection.

    Columns are matched without case; values that can't be cast become null (guard with
    ``cast_losses`` first). A missing column is its default or null; a missing required one an error.
    """
    have = {c.lower(): c for c in df.columns}
    defaults = {k.lower(): v for k, v in (defaults or {}).items()}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        name = have.get(f.name.lower())
        if name is not None:
            c = quoted(name)
            out.append((c if kinds[name] == f.dataType else c.try_cast(f.dataType)).alias(f.name))
        elif f.name.lower() in {r.lower() for r in required}:
            raise MergeError(f"HDR_001 required column {f.name!r} is missing")
        else:
            out.append(F.lit(defaults.get(f.name.lower())).cast(f.dataType).alias(f.name))
    return df.select(*out)


def _side(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[quoted(c).alias(prefix + c) for c in df.columns], F.lit(True).alias("__here_" + prefix))


def merge(incoming: DataFrame, target: DataFrame, spec: MergeSpec, small: bool | None = None) -> DataFrame:
    """All rows of the table after the merge, with ``_outcome``.

    ``incoming`` must have one row per key and no blank keys (``prepare_batch``); it is
    aligned to the target's columns. The target keeps one row per key. Updates keep the target's
    ``create_timestamp`` and get ``last_modified_op`` U. A winning tombstone becomes a
    retained row with op D and ``is_deleted`` true, where those columns exist. Outcomes: unchanged (key not in the batch),
    inserted, updated, deleted, ignored (the target's row stays, be it fresher or equal). ``small`` says
    whether the batch may be broadcast; unset, its bytes are measured if the target is large
    enough for that to pay. An empty batch leaves the target as it is; an empty target takes all.
    """
    prepare(target.sparkSession)
    if small is None:
        small = stored_bytes(target) > LARGE_TARGET * BROADCAST_BYTE_CAP
        if small:
            incoming = cut(incoming)
            small = small_enough(incoming)
    names = target.columns
    lower = {c.lower(): c for c in names}
    if OUTCOME in lower:
        raise MergeError(f"the target has a column named {OUTCOME}")
    keys = [lower[k.lower()] for k in spec.keys]
    terms = resolve(spec.terms(), names)
    for t in terms:
        if isinstance(target.schema[t.column].dataType, T.MapType | T.ArrayType | T.StructType) and not (t.kind or t.pattern):
            raise MergeError(f"CUR_008 column {t.column!r} can't be ordered")
    indicator = None
    if spec.deletes == "SOFT":
        if spec.indicator.lower() not in lower:
            raise MergeError(f"indicator column {spec.indicator!r} is not in the target")
        indicator = lower[spec.indicator.lower()]
    i, t = _side(align(incoming, target.schema), "i_"), _side(target, "t_")
    on = F.lit(True)
    for k in keys:
        on = on & quoted("t_" + k).eqNullSafe(quoted("i_" + k))
    I, O = (lambda c: quoted("i_" + c)), (lambda c: quoted("t_" + c))  # noqa: E741
    here_i, here_t = F.coalesce(F.col("__here_i_"), F.lit(False)), F.coalesce(F.col("__here_t_"), F.lit(False))
    dead = is_tombstone(spec, I(indicator)) if indicator else F.lit(False)
    hashed = lower.get(spec.hash_column.lower())
    same = (~dead & I(hashed).eqNullSafe(O(hashed)) & I(hashed).isNotNull()) if hashed and terms else F.lit(False)
    fresher = precedes(terms, I, O) if terms else F.lit(True)
    # an unknown version on either side advances nothing
    newer = F.coalesce(terms[0].value(I(terms[0].column)) > terms[0].value(O(terms[0].column)), F.lit(False)) if hashed and terms else F.lit(False)
    outcome = (
        F.when(~here_i, UNCHANGED)
        .when(~here_t, F.when(dead, DELETED).otherwise(INSERTED))
        .when(same, IGNORED)
        .when(fresher, F.when(dead, DELETED).otherwise(UPDATED))
        .otherwise(IGNORED)
    )
    wins = here_i & (~here_t | (~same & fresher))
    advance = here_i & here_t & same & newer
    version = {x.column for x in terms}
    out = []
    for c in names:
        low = c.lower()
        taken = I(c)
        if low == "create_timestamp":
            taken = F.when(here_t, F.coalesce(O(c), I(c))).otherwise(I(c))
        elif low == "last_modified_op":
            taken = F.when(dead, F.lit("D")).when(here_t, F.lit("U")).otherwise(I(c))
        elif low == "is_deleted" and indicator:
            taken = F.when(dead, F.lit(True)).otherwise(I(c).cast("boolean"))
        kept = F.when(advance, I(c)).otherwise(O(c)) if c in version else O(c)
        out.append(F.when(wins, taken).otherwise(kept).alias(c))
    out.append(outcome.alias(OUTCOME))
    if not small:
        return t.join(i, on, "full").select(*out)
    stayed = t.join(F.broadcast(i), on, "left").select(*out)
    met = target.select(*[quoted(k).alias("t_" + k) for k in keys]).join(F.broadcast(i.select(*["i_" + k for k in keys])), on, "left_semi")
    fresh = i.join(F.broadcast(met.distinct()), on, "left_anti")  # at most the batch's own keys
    blank = {f"t_{f.name}": F.lit(None).cast(f.dataType) for f in target.schema.fields} | {"__here_t_": F.lit(None).cast("boolean")}
    return stayed.unionByName(fresh.withColumns(blank).select(*out))


def prepare_batch(df: DataFrame, spec: MergeSpec, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row per key, rows without a key). The order is the freshness order followed by ``order``."""
    valid, keyless = split_blank_keys(df, list(spec.keys))
    terms = [*spec.terms(), *parse_terms(order or [])]
    return latest_per_key(valid, list(spec.keys), terms), keyless


def check_freshness(df: DataFrame, spec: MergeSpec) -> None:
    """Refuses values that would silently lose every contest because they can't be read."""
    if not unchecked_casts(df, [t for t in spec.terms() if t.column == spec.freshness]).isEmpty():
        raise MergeError(f"CUR_008 values of {spec.freshness!r} can't be read as {spec.compare_format or spec.compare_as}")


def outcome_counts(merged: DataFrame) -> DataFrame:
    """One row: how many keys were inserted, updated, deleted, ignored; disjoint."""
    n = lambda o: F.coalesce(F.sum((F.col(OUTCOME) == o).cast("bigint")), F.lit(0)).alias(o)
    return merged.agg(*map(n, (INSERTED, UPDATED, DELETED, IGNORED)))


def with_passthrough(merged: DataFrame, keyless: DataFrame, columns: list[str]) -> DataFrame:
    """The merged rows plus keyless ones, which never compete."""
    schema = T.StructType([f for f in merged.schema.fields if f.name in columns])
    return merged.unionByName(align(keyless, schema).withColumn(OUTCOME, F.lit(PASSED)))


def full_publish(incoming: DataFrame, target: DataFrame | None, spec: MergeSpec) -> DataFrame:
    """The batch as the whole table; with absence deletes, target keys missing from it stay as tombstones.

    Tombstones from before are kept with outcome unchanged; newly missing keys have
    outcome absent, op D and ``is_deleted`` true where the columns exist. A key that
    comes again is live again.
    """
    if target is None:
        return incoming.withColumn(OUTCOME, F.lit(INSERTED))
    prepare(target.sparkSession)
    rows = align(incoming, target.schema).withColumn(OUTCOME, F.lit(INSERTED))
    if spec.deletes != "FULL_SNAPSHOT_ABSENCE":
        return rows
    lower = {c.lower(): c for c in target.columns}
    keys = [lower[k.lower()] for k in spec.keys]
    i = rows.select(*[quoted(k).alias("i_" + k) for k in keys]).distinct()
    on = F.lit(True)
    for k in keys:
        on = on & quoted(k).eqNullSafe(quoted("i_" + k))
    gone = target.join(i, on, "left_anti")
    dead = F.lit(False)
    if "last_modified_op" in lower:
        dead = F.coalesce(quoted(lower["last_modified_op"]) == "D", F.lit(False))
    gone = gone.withColumn(OUTCOME, F.when(dead, F.lit(UNCHANGED)).otherwise(F.lit(ABSENT)))
    marks = {}
    if "last_modified_op" in lower:
        marks[lower["last_modified_op"]] = F.lit("D")
    if "is_deleted" in lower:
        marks[lower["is_deleted"]] = F.lit(True)
    return rows.unionByName(gone.withColumns(marks) if marks else gone)


#: Most partitions that are named as literals in a filter.
LITERAL_PARTITIONS = 1_000


def affected_partitions(incoming: DataFrame, target: DataFrame, spec: MergeSpec) -> DataFrame:
    """Partitions a scoped merge rewrites: those of the batch, and those its keys lie in now.

    The target is only asked for the latter if partition columns aren't part of the key,
    as only then a key can move.
    """
    cols = list(spec.partition_columns)
    new = incoming.select(*[quoted(c).cast(target.schema[c].dataType).alias(c) for c in cols])
    if set(cols) <= set(spec.keys):
        return new.distinct()
    keys = incoming.select(*[quoted(k).alias("i_" + k) for k in spec.keys])
    on = F.lit(True)
    for k in spec.keys:
        on = on & quoted(k).eqNullSafe(quoted("i_" + k))
    slim = target.select(*dict.fromkeys([*spec.keys, *cols]))
    if small_enough(keys):
        keys = F.broadcast(keys)
    old = slim.join(keys, on, "left_semi").select(*cols)
    return new.unionByName(old).distinct()


def partition_slice(target: DataFrame, partitions: DataFrame, cap: int = LITERAL_PARTITIONS) -> DataFrame:
    """The target's rows in these partitions: by literals the scan can prune with, or by a semi-join beyond ``cap``."""
    cols = partitions.columns
    got = partitions.limit(cap + 1).collect()
    if len(got) > cap:
        keys = partitions.select(*[quoted(c).alias("p_" + c) for c in cols])
        on = F.lit(True)
        for c in cols:
            on = on & quoted(c).eqNullSafe(quoted("p_" + c))
        return target.join(F.broadcast(keys) if small_enough(keys) else keys, on, "left_semi")
    keep = F.lit(False)
    for row in got:
        one = F.lit(True)
        for c in cols:
            one = one & quoted(c).eqNullSafe(F.lit(row[c]))
        keep = keep | one
    return target.filter(keep)


def scoped_merge(incoming: DataFrame, target: DataFrame, spec: MergeSpec) -> tuple[DataFrame, DataFrame]:
    """(rows of the affected partitions after the merge, affected partitions); all others stay as they are."""
    partitions = affected_partitions(incoming, target, spec)
    return merge(incoming, partition_slice(target, partitions), spec), partitions


def emptied_partitions(affected: DataFrame, written: DataFrame) -> DataFrame:
    """Affected partitions that hold no row any more and have to be dropped."""
    return affected.exceptAll(written.select(*affected.columns).distinct())


def null_partitions(df: DataFrame, columns: list[str], policy: str, defaults: dict[str, object] | None = None) -> DataFrame:
    """REJECT refuses null partition values, DEFAULT replaces them, HIVE leaves them."""
    if policy == "DEFAULT":
        kinds = {f.name: f.dataType for f in df.schema.fields}
        return df.withColumns({c: F.coalesce(quoted(c), F.lit((defaults or {})[c]).cast(kinds[c])) for c in columns})
    if policy == "REJECT":
        bad = F.lit(False)
        for c in columns:
            bad = bad | quoted(c).isNull()
        if not df.filter(bad).isEmpty():
            raise MergeError(f"CUR_006 null partition value in {', '.join(columns)}")
    elif policy != "HIVE":
        raise MergeError(f"null partition policy {policy!r} must be REJECT, DEFAULT or HIVE")
    return df


