"""Ordered replay of inserts, updates and deletes into current state.

A change is keyed, ordered by (time, sequence) and either inserts (replaces the
whole row), upserts (sets only the columns it carries) or deletes. The replay runs
twice: each input partition is sorted and folded where it lies, then the partial
states are repartitioned by key, sorted and folded again. The fold keeps a version
per column and the version of the last reset, which makes it independent of how the
changes were split; a key with a third of all rows arrives at its task as at most
one state per input partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.instants import micros_of
from sluice.functions.text import canonical_id, change_kind

UPSERT, INSERT, DELETE = 0, 1, 2
#: Order of a change whose time is null: before every other.
EARLIEST = -(2**63)


@dataclass(frozen=True)
class ChangeFeed:
    """Names the parts of a change row; ``columns`` are those the state carries."""

    key: str
    time: str
    sequence: str
    operation: str
    landing: str
    columns: tuple[str, ...]


def lift(changes: DataFrame, feed: ChangeFeed) -> DataFrame:
    """Change rows as single-change states. Rows without key or sequence are left out."""
    kinds = {f.name: f.dataType for f in changes.schema.fields}
    ts = F.coalesce(micros_of(F.col(feed.time), kinds[feed.time]), F.lit(EARLIEST))
    base = changes.select(
        canonical_id(F.col(feed.key)).alias("key"),
        ts.alias("ts"),
        F.col(feed.sequence).cast("bigint").alias("seq"),
        change_kind(F.col(feed.operation)).cast("tinyint").alias("kind"),
        (-F.col(feed.landing).cast("bigint")).alias("landing"),
        *[F.col(c).alias(f"v_{i}") for i, c in enumerate(feed.columns)],
    ).filter(F.col("key").isNotNull() & F.col("seq").isNotNull())
    reset = F.col("kind") > UPSERT
    out = [F.col("key"), F.col("ts"), F.col("seq"), F.col("kind"), F.when(reset, F.col("ts")).alias("reset_ts"), F.when(reset, F.col("seq")).alias("reset_seq")]
    for i in range(len(feed.columns)):
        carried = (F.col("kind") != DELETE) & F.col(f"v_{i}").isNotNull()
        out += [F.when(carried, F.col(f"v_{i}")).alias(f"v_{i}")]
        out += [F.when(carried, F.col(n)).alias(f"{m}_{i}") for n, m in (("ts", "vt"), ("seq", "vs"), ("landing", "vl"))]
    return base.select(*out)


def _longs(t: pa.Table, name: str) -> np.ndarray:
    return pc.fill_null(t.column(name).cast(pa.int64()), EARLIEST).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _in_order(group: np.ndarray, version: list[np.ndarray]) -> bool:
    """Whether versions never fall inside a group."""
    tie, falls = group[1:] == group[:-1], False
    for v in version:
        falls = falls or bool((tie & (v[1:] < v[:-1])).any())
        tie = tie & (v[1:] == v[:-1])
    return not falls


def _winners(group: np.ndarray, n: int, valid: np.ndarray, *version: np.ndarray) -> np.ndarray:
    """Per group the position of the valid row with the highest version, else -1.

    Changes come sorted, so the last valid row of a group is the one; a change that comes
    again has been applied and is passed over. Versions of columns inside states that were
    folded before may be older than the state, only then they are sorted again.
    """
    at = np.flatnonzero(valid)
    out = np.full(n, -1, dtype=np.int64)
    if at.size:
        g, v = group[at], [x[at] for x in version]
        if not _in_order(g, v):
            order = np.lexsort((*reversed(v), g))
            at, g = at[order], g[order]
        last = np.append(g[1:] != g[:-1], True)
        out[g[last]] = at[last]
    return out


def _take(column: pa.ChunkedArray, at: np.ndarray) -> pa.Array:
    got = column.combine_chunks().take(pa.array(np.maximum(at, 0)))
    if not (at < 0).any():
        return got
    return pc.if_else(pa.array(at >= 0), got, pa.scalar(None, got.type))


def fold(t: pa.Table, n_columns: int) -> pa.Table:
    """One state per key of a table sorted by key, ts, seq."""
    keys = t.column("key").combine_chunks()
    start = np.append(True, pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False))
    group = np.cumsum(start) - 1
    n = int(group[-1]) + 1
    ts, seq = _longs(t, "ts"), _longs(t, "seq")
    every = np.ones(len(group), dtype=bool)
    last = _winners(group, n, every, ts, seq, _longs(t, "kind"))
    reset_valid = pc.is_valid(t.column("reset_seq")).to_numpy()
    reset = _winners(group, n, reset_valid, _longs(t, "reset_ts"), _longs(t, "reset_seq"))
    out = {c: _take(t.column(c), last) for c in ("key", "ts", "seq", "kind")}
    out |= {c: _take(t.column(c), reset) for c in ("reset_ts", "reset_seq")}
    rt, rs = _longs(t, "reset_ts")[np.maximum(reset, 0)], _longs(t, "reset_seq")[np.maximum(reset, 0)]
    for i in range(n_columns):
        vt, vs, vl = (_longs(t, f"{m}_{i}") for m in ("vt", "vs", "vl"))
        at = _winners(group, n, pc.is_valid(t.column(f"vs_{i}")).to_numpy(), vt, vs, vl)
        a = np.maximum(at, 0)
        older = (reset >= 0) & ((vt[a] < rt) | ((vt[a] == rt) & (vs[a] < rs)))
        at = np.where(older, -1, at)
        out |= {f"{m}_{i}": _take(t.column(f"{m}_{i}"), at) for m in ("v", "vt", "vs", "vl")}
    return pa.table(out)


def _fold_sorted(n_columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.Table | None = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.table({c: b.column(c) for c in b.schema.names})  # without the flags of Spark's schema
            if carry is not None:
                t = pa.concat_tables([carry, t.select(carry.column_names)])
            done = fold(t, n_columns)
            carry = done.slice(done.num_rows - 1)
            yield from done.slice(0, done.num_rows - 1).combine_chunks().to_batches()
        if carry is not None:
            yield from carry.combine_chunks().to_batches()

    return run


def replay(lifted: DataFrame, n_columns: int) -> DataFrame:
    """States of all keys from states or single changes, in any order and number.

    A change that comes again has the version it had before and changes nothing. If
    copies of one change carry different columns, each column comes from its earliest
    landing that carries it; a delete outranks other codes of the same change.
    """
    # copies of one change by landing, so that the earliest comes last
    order = ["key", "ts", "seq", "kind", *[f"vl_{i}" for i in range(n_columns)]]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in lifted.schema.fields])
    partial = lifted.sortWithinPartitions(*order).mapInArrow(_fold_sorted(n_columns), schema)
    return partial.repartition("key").sortWithinPartitions(*order).mapInArrow(_fold_sorted(n_columns), schema)


def apply_changes(changes: DataFrame, feed: ChangeFeed, state: DataFrame | None = None) -> DataFrame:
    """The state after ``changes``, on top of an earlier ``state`` of this function if given.

    Deleted keys stay as tombstones (kind 2), so that a late older change cannot bring
    them back; ``live`` drops them. An empty feed gives the earlier state, or no row.
    Null times order first, then the sequence decides. Null columns of an upsert leave
    the column as it was.
    """
    rows = lift(changes, feed)
    if state is not None:
        rows = rows.unionByName(state)
    return replay(rows, len(feed.columns))


def live(state: DataFrame, feed: ChangeFeed) -> DataFrame:
    """Rows that exist in the end, under their own names."""
    return state.filter(F.col("kind") != DELETE).select(
        F.col("key").alias(feed.key), F.col("seq").alias(feed.sequence), *[F.col(f"v_{i}").alias(c) for i, c in enumerate(feed.columns)]
    )
