"""Topic records: decoding, offsets as text, committed ranges."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stand-ins for the first and the next offset.
EARLIEST, LATEST = -2, -1
OFFSET_SCHEMA = "entity string, topic string, partition int, from_offset bigint, until_offset bigint, run_id string, event_ts timestamp"


def decode(records: DataFrame, fmt: str = "json", schema: str | T.StructType | None = None) -> DataFrame:
    """Record metadata, a tombstone flag, and the payload's fields (json) or the value as text (string).

    A null value is a tombstone and keeps its key. Payloads that aren't valid JSON give
    null fields. Fields that clash with the metadata names are refused.
    """
    base = records.withColumns({"kafka_tombstone": F.col("value").isNull(), "__text": F.col("value").cast("string")})
    meta = [F.col("key").cast("string").alias("kafka_key"), *[F.col(c).alias(f"kafka_{c}") for c in ("topic", "partition", "offset", "timestamp")], F.col("kafka_tombstone")]
    if fmt == "string":
        return base.select(*meta, F.col("__text").alias("value"))
    if fmt != "json":
        raise ValueError(f"payload format {fmt!r} must be json or string")
    if schema is None:
        raise ValueError("a JSON payload needs its schema")
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) and not schema.lstrip().startswith("{") else schema
    kind = T.StructType.fromJson(json.loads(kind)) if isinstance(kind, str) else kind
    clash = {f.name.lower() for f in kind.fields} & {"kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "kafka_tombstone"}
    if clash:
        raise ValueError(f"payload fields {', '.join(sorted(clash))} clash with the metadata")
    return base.select(*meta, F.from_json("__text", kind).alias("__v")).select("kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "kafka_tombstone", "__v.*")


def offsets_json(topic: str, offsets: dict[int, int]) -> str:
    return json.dumps({topic: {str(p): offsets[p] for p in sorted(offsets)}}, separators=(",", ":"))


def parse_offsets(text: str) -> dict[str, dict[int, int]]:
    return {t: {int(p): int(o) for p, o in ps.items()} for t, ps in json.loads(text).items()}


def starting_offsets(topic: str, partitions: list[int], done: dict[int, int], default: int = EARLIEST) -> str:
    """Where a read begins: after what is committed, else at the default."""
    return offsets_json(topic, {p: done.get(p, default) for p in partitions})


def committed(ranges: DataFrame) -> DataFrame:
    """Per entity, topic and partition the end of what is committed."""
    return ranges.groupBy("entity", "topic", "partition").agg(F.max("until_offset").alias("until_offset"))


def ranges_read(records: DataFrame, entity: str, run_id: str) -> DataFrame:
    """The range [from, until) per topic and partition of decoded records, to be committed with their output."""
    per = records.groupBy(F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition")).agg(F.min("kafka_offset").alias("from_offset"), (F.max("kafka_offset") + 1).alias("until_offset"))
    return per.select(F.lit(entity).alias("entity"), "topic", "partition", "from_offset", "until_offset", F.lit(run_id).alias("run_id"))


def read_batch(spark: SparkSession, servers: str, topic: str, start: str, end: str, options: dict[str, str] | None = None) -> DataFrame:
    """Records between pinned offsets; needs Spark's Kafka package on the classpath."""
    return spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", start).option("endingOffsets", end).options(**(options or {})).load()


def read_stream(spark: SparkSession, servers: str, topic: str, start: str = "earliest", most_per_trigger: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """The topic as a stream; where it stands is kept by the query's checkpoint. Needs Spark's Kafka package."""
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", start).options(**(options or {}))
    return (r.option("maxOffsetsPerTrigger", most_per_trigger) if most_per_trigger else r).load()


def end_offsets(spark: SparkSession, servers: str, topic: str, options: dict[str, str] | None = None) -> dict[int, int]:
    """The next offset of every partition as the brokers state it now; needs the Kafka client on the classpath."""
    jvm = spark._jvm
    conf = jvm.java.util.Properties()
    deserializer = "org.apache.kafka.common.serialization.ByteArrayDeserializer"
    for k, v in {"bootstrap.servers": servers, "key.deserializer": deserializer, "value.deserializer": deserializer, **(options or {})}.items():
        conf.setProperty(k, v)
    consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(conf)
    try:
        parts = jvm.java.util.ArrayList()
        for p in consumer.partitionsFor(topic):
            parts.add(jvm.org.apache.kafka.common.TopicPartition(topic, p.partition()))
        return {e.getKey().partition(): int(e.getValue()) for e in consumer.endOffsets(parts).entrySet()}
    finally:
        consumer.close()


class RangeError(RuntimeError):
    """Offsets that can't be read as planned."""


def pinned_ranges(done: dict[int, int], ends: dict[int, int], default: int = EARLIEST) -> dict[int, tuple[int, int]]:
    """[from, until) of every partition that has something to read.

    It starts after what is committed, or at ``default`` for a partition that is new, and ends
    at the offset pinned before the read, so that a read repeated after a failure sees
    the same records. A commit beyond the end means that the topic was made anew.
    """
    behind = sorted(p for p, at in done.items() if at > ends.get(p, at))
    if behind:
        raise RangeError(f"partitions {', '.join(map(str, behind))} end before what is committed")
    return {p: (done.get(p, default), end) for p, end in sorted(ends.items()) if done.get(p, default) < end and end > 0}


class LedgerReader:
    """Batch reads of a topic whose position is a table of committed ranges.

    ``committed_ranges`` gives the table's rows, ``append`` adds some, ``ends`` the brokers' end
    offsets, ``fetch`` reads between two offset texts. A range counts once its run has
    committed; a run that fails leaves none and is read again.
    """

    def __init__(self, entity: str, topic: str, committed_ranges: Callable[[], DataFrame], append: Callable[[DataFrame], object], ends: Callable[[], dict[int, int]], fetch: Callable[[str, str], DataFrame]):
        self.entity, self.topic = entity, topic
        self._ranges, self._append, self._ends, self._fetch = committed_ranges, append, ends, fetch
        self.open: dict[str, dict[int, tuple[int, int]]] = {}

    def position(self) -> dict[int, int]:
        own = self._ranges().filter((F.col("entity") == self.entity) & (F.col("topic") == self.topic))
        return {r.partition: r.until_offset for r in committed(own).collect()}

    def read(self, run_id: str) -> DataFrame | None:
        """The records to process now; None for none."""
        ranges = pinned_ranges(self.position(), self._ends())
        self.open[run_id] = ranges
        if not ranges:
            return None
        return self._fetch(*(offsets_json(self.topic, {p: r[i] for p, r in ranges.items()}) for i in (0, 1)))

    def commit(self, run_id: str, spark: SparkSession) -> int:
        """Saves the ranges of a run; returns how many."""
        ranges = self.open.pop(run_id)
        at = dt.datetime.now(dt.UTC).replace(tzinfo=None)
        rows = [(self.entity, self.topic, p, a, b, run_id, at) for p, (a, b) in ranges.items()]
        if rows:
            self._append(spark.createDataFrame(rows, OFFSET_SCHEMA))
        return len(rows)

    def discard(self, run_id: str) -> None:
        self.open.pop(run_id, None)
