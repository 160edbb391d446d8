"""Sources and sinks by name; each kind is a function of the session and its options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.operators.publish import append_raw
from sluice.sources.files import FileFormat, read_files
from sluice.sources.jdbc import JdbcSource, read
from sluice.sources.kafka import read_batch, read_stream
from sluice.sources.kinds import Registry, UnknownKind

__all__ = ["SINKS", "SOURCES", "Registry", "UnknownKind"]


SOURCES, SINKS = Registry("source"), Registry("sink")


def _file(spark: SparkSession, path: str | None = None, paths: list[str] | None = None, **options) -> DataFrame:
    """Explicit paths win over a pattern."""
    if not (paths or path):
        raise ValueError("a file source needs paths or a path")
    return read_files(spark, paths or path, FileFormat(**options))


SOURCES.register("file", _file)
SOURCES.register("jdbc", lambda spark, **options: read(spark, JdbcSource(**options)))
SOURCES.register("kafka", lambda spark, **options: read_batch(spark, **options))
SOURCES.register("kafka_stream", lambda spark, **options: read_stream(spark, **options))
SOURCES.register("table", lambda spark, name: spark.table(name))
SINKS.register("table", lambda df, name, **options: append_raw(df, name, **options))
SINKS.register("files", lambda df, path, fmt="parquet", mode="append": df.write.format(fmt).mode(mode).save(path))
