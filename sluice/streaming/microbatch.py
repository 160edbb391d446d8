"""The merge as a sink of micro-batches.

Delivery is at least once: a batch that comes again changes nothing, since its rows tie
with what they wrote before. Late rows need no watermark; they lose the freshness
contest.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.merge import OUTCOME, MergeError, MergeSpec, merge, outcome_counts, prepare_batch, with_passthrough
from sluice.operators.publish import SHRINK_PERCENT, Guards, publish


@dataclass(frozen=True)
class MicroBatchMerge:
    """Merges each batch into a table; ``decode`` turns records into rows of the table first.

    ``on_counts`` is told the run id (``stream-<batch id>``) and the outcome of each batch.
    Rows without key are left out unless ``keep_keyless``.
    """

    table: str
    spec: MergeSpec
    decode: Callable[[DataFrame], DataFrame] | None = None
    order: tuple[str, ...] = ()
    keep_keyless: bool = False
    publish_mode: str = "MERGE"
    allow_full_overwrite: bool = False
    on_counts: Callable[[str, dict], None] | None = None

    def __post_init__(self):
        if self.publish_mode == "FULL_OVERWRITE" and not self.allow_full_overwrite:
            raise MergeError("CUR_007 a micro-batch must not replace the whole table")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        rows = self.decode(batch) if self.decode else batch
        valid, keyless = prepare_batch(rows, self.spec, list(self.order))
        if not spark.catalog.tableExists(self.table):
            publish(valid, self.table, Guards(unique_keys=self.spec.keys))
            return
        target = spark.table(self.table)
        merged = merge(valid, target, self.spec)
        if self.keep_keyless:
            merged = with_passthrough(merged, keyless, target.columns)
        counts: dict = {}
        guards = Guards(unique_keys=self.spec.keys, max_shrink_percent=SHRINK_PERCENT)
        publish(merged, self.table, guards, aside=(OUTCOME,), inspect=lambda staged: counts.update(outcome_counts(staged).first().asDict()))
        if self.on_counts:
            self.on_counts(f"stream-{batch_id}", counts)


def start(stream: DataFrame, sink: MicroBatchMerge, checkpoint: str, trigger_seconds: int | None = None, available_now: bool = False) -> StreamingQuery:
    """Runs the merge over a stream; a checkpoint folder is mandatory (KAF_002)."""
    if not checkpoint:
        raise ValueError("KAF_002 a streaming merge needs a checkpoint folder")
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
