"""Landed batches: slices, and what keeps a batch from landing twice."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import quoted
from sluice.session import small_enough


def slice_of(landed: DataFrame, run_id: str | None = None, ingest_dt: str | None = None, file_type: str | None = None, file_id: str | None = None) -> DataFrame:
    """Rows of a run, or of a landing day and file type; filters the scan can prune with."""
    if run_id is None and ingest_dt is None:
        raise ValueError("a slice needs a run or a landing day")
    for c, v in (("run_id", run_id), ("ingest_dt", ingest_dt), ("file_type", file_type), ("file_id", file_id)):
        if v is not None:
            landed = landed.filter(quoted(c) == v)
    return landed


def window_slice(landed: DataFrame, window: tuple[str, str]) -> DataFrame:
    """Rows of an extraction window, whichever run has landed them."""
    return landed.filter((F.col("extract_start_ts") == window[0]) & (F.col("extract_end_ts") == window[1]))


def drifted_end(landed: DataFrame, run_id: str, window: tuple[str, str]) -> bool:
    """Whether another run has landed a window with this start and another end: what both cover lands twice."""
    other = (F.col("run_id") != run_id) & (F.col("extract_start_ts") == window[0]) & (F.col("extract_end_ts") != window[1])
    return not landed.filter(other).isEmpty()


def counts_by_run(landed: DataFrame) -> DataFrame:
    return landed.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"))


def not_landed(batch: DataFrame, landed: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose version (``key``, null-safe) has not landed yet; extra columns don't matter.

    Few keys are broadcast to the history, of which only the matching ones are shuffled;
    for many both sides are. Either way the history is read by its key columns alone.
    """
    same = lambda left, right: reduce(and_, (F.col(f"{left}{i}").eqNullSafe(F.col(f"{right}{i}")) for i in range(len(key))))
    named = lambda df, prefix: df.select(*[quoted(k).alias(f"{prefix}{i}") for i, k in enumerate(key)])
    old, own = named(landed, "__l_"), named(batch, "__b_")
    on = reduce(and_, (quoted(k).eqNullSafe(F.col(f"__l_{i}")) for i, k in enumerate(key)))
    if not small_enough(own):
        return batch.join(old, on, "left_anti")
    known = old.join(F.broadcast(own.distinct()), same("__l_", "__b_"), "left_semi").distinct()
    return batch.join(F.broadcast(known), on, "left_anti")  # at most the batch's own keys


def without_loaded_files(batch: DataFrame, landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of files that have not landed, ids of those that have)."""
    ids = batch.select("file_id").distinct()
    loaded = landed.select("file_id").join(F.broadcast(ids) if small_enough(ids) else ids, "file_id", "left_semi").distinct()
    rest = batch.join(F.broadcast(loaded) if small_enough(loaded) else loaded, "file_id", "left_anti")
    return rest.select(*[quoted(c) for c in batch.columns]), loaded


def decision(landed: DataFrame, run_id: str, window: tuple[str, str] | None = None, held: bool = False, force: bool = False) -> str:
    """APPEND, SKIP_RUN (the run has landed) or SKIP_WINDOW (another run has landed the window, and it isn't held)."""
    if force:
        return "APPEND"
    if not landed.filter(F.col("run_id") == run_id).isEmpty():
        return "SKIP_RUN"
    if window and not held and window[1]:
        if not window_slice(landed, window).isEmpty():
            return "SKIP_WINDOW"
    return "APPEND"
