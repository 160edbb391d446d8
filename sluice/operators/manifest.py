"""Incremental processing by diffing manifests of immutable data.

A manifest lists the immutable units of a table version. ``diff`` compares two; added
and kept units give the records that are new, and records of an added unit that a kept
one carries too are masked like entries of a deletion vector. ``VersionedTable`` keeps
the versions: a commit writes new files and the actions on files (added, removed,
deletion vector grown) and becomes visible by one atomic rename of its commit file,
which also names the source version it has processed, so the output and the position
it stands for are saved together.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import cut, lookup_join, small_enough

MANIFEST_SCHEMA = "file string, n_rows bigint, deleted array<bigint>"
#: Most commits whose folders are named as literals in a filter.
LITERAL_RUNS = 1_000


def manifest(rows: DataFrame, unit: list[str]) -> DataFrame:
    """One row per unit with its number of rows; null parts of a unit's name are kept."""
    return rows.groupBy(*unit).agg(F.count(F.lit(1)).alias("n_rows"))


def diff(current: DataFrame, processed: DataFrame, unit: list[str]) -> DataFrame:
    """``change`` is added, removed or kept for every unit of either manifest."""
    both = current.select(*unit, F.lit(1).alias("c"), F.lit(0).alias("p")).unionByName(processed.select(*unit, F.lit(0).alias("c"), F.lit(1).alias("p")))
    seen = both.groupBy(*unit).agg(F.max("c").alias("c"), F.max("p").alias("p"))
    change = F.when(F.col("p") == 0, F.lit("added")).when(F.col("c") == 0, F.lit("removed")).otherwise(F.lit("kept"))
    return seen.select(*unit, change.alias("change"))


def record_delta(rows: DataFrame, changes: DataFrame, unit: list[str], record: list[str], carried: list[Column]) -> DataFrame:
    """Records of added units that no kept unit carries, each once.

    ``changes`` is what ``diff`` gives for the units of ``rows``. Units are equal if all
    parts are, null only to null. ``carried`` are aggregates over a record's rows to return
    with it. Few added records are looked up where the kept ones lie, so history is
    read but not shuffled; many are pre-aggregated together with the kept ones before the
    shuffle. Neither a hot unit nor a record landed very often gathers in one task.
    """
    states = changes.filter(F.col("change") != "removed").select(*unit, (F.col("change") == "kept").cast("int").alias("__kept"))
    flagged = lookup_join(rows, states, unit, "inner")
    added = cut(flagged.filter(F.col("__kept") == 0).groupBy(*record).agg(*carried))
    if small_enough(added):
        keys = added.select(*[F.col(c).alias(f"__r_{i}") for i, c in enumerate(record)])
        same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"__r_{i}")) for i, c in enumerate(record)))
        masked = flagged.filter(F.col("__kept") == 1).join(F.broadcast(keys), same, "left_semi").select(*[F.col(c).alias(f"__r_{i}") for i, c in enumerate(record)]).distinct()
        return added.join(F.broadcast(masked), same, "left_anti")  # at most the added records themselves
    per_record = flagged.groupBy(*record).agg(*carried, F.max("__kept").alias("__kept"))
    return per_record.filter(F.col("__kept") == 0).drop("__kept")


def process_units(rows: DataFrame, done: DataFrame, unit: list[str], record: list[str], carried: list[Column], out: VersionedTable, source: str) -> int:
    """One incremental run over landed units: appends the records of units not processed yet to ``out``.

    ``done`` names units processed elsewhere (repeats allowed); those processed by earlier
    commits of ``out`` are kept with it. The records, the units they came from and the
    source version (how many units have been processed) are one commit: a run that fails
    before it leaves nothing, one that fails after it isn't repeated. Without added units
    nothing is written, except the first version. Returns the version of ``out``.
    """
    base = out.version()
    names = rows.select(*unit).schema
    before = done.select(*unit).unionByName(out.attached("units", names).select(*unit))
    changes = cut(diff(manifest(rows, unit), before.distinct(), unit))
    added = changes.filter(F.col("change") == "added").select(*unit)
    if base >= 0 and added.isEmpty():
        return base
    n = changes.filter(F.col("change") != "removed").count()
    return out.commit(base, added=record_delta(rows, changes, unit, record, carried), processed={source: n}, attach={"units": added})


class VersionedTable:
    """A folder of immutable Parquet files with a log of versions.

    ``data/run=<id>/`` holds the files of a commit, ``log/run=<id>/`` its actions on files,
    ``<name>/run=<id>/`` what else it saves, ``commits/<version>.json`` names the commit and
    the source versions it has processed. A version exists exactly when its commit file
    does; files of a failed attempt are named by no log that counts and never read. The
    state of a version is the latest action on each file, found without a list on the driver.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._Path = self._hadoop.Path
        self._fs = self._Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        return self._fs.exists(self._Path(f"{self.path}/{name}"))

    def version(self) -> int:
        """The last committed version, -1 before the first commit."""
        if not self._exists("commits"):
            return -1
        names = [s.getPath().getName() for s in self._fs.listStatus(self._Path(f"{self.path}/commits"))]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=-1)

    def commit_info(self, version: int) -> dict:
        text = self.spark.read.text(f"{self.path}/commits/{version}.json", wholetext=True).first()
        return json.loads(text.value)

    def processed(self, source: str) -> int:
        """Version of ``source`` this table has processed, -1 if none."""
        v = self.version()
        return -1 if v < 0 else int(self.commit_info(v)["processed"].get(source, -1))

    def _commits(self, version: int) -> DataFrame:
        """(version, run) of the commits up to a version."""
        return self.spark.read.schema("version bigint, run string").json(f"{self.path}/commits").filter(F.col("version") <= version)

    def _committed(self, name: str, schema: str, version: int) -> DataFrame:
        """Rows saved under ``name`` by the commits up to a version, with ``version`` and ``run``."""
        if version < 0 or not self._exists(name):
            return self.spark.createDataFrame([], f"{schema}, run string, version bigint")
        rows = self.spark.read.schema(f"{schema}, run string").parquet(f"{self.path}/{name}")
        return lookup_join(rows, self._commits(version), ["run"], "inner")

    def attached(self, name: str, schema: T.StructType, version: int | None = None) -> DataFrame:
        """What commits saved under ``name`` besides their rows."""
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        return self._committed(name, ddl, self.version() if version is None else version).drop("run", "version")

    def _states(self, *versions: int) -> DataFrame:
        """Per file its state in each version: a struct ``s0``, ``s1``, null where it isn't part of it."""
        log = self._committed("log", f"{MANIFEST_SCHEMA}, removed boolean", max(versions))
        last = [F.max_by(F.struct("n_rows", "deleted", "removed"), F.when(F.col("version") <= v, F.col("version"))).alias(f"s{i}") for i, v in enumerate(versions)]
        every = log.groupBy("file").agg(*last)
        return every.select("file", *[F.when(~F.col(f"s{i}.removed"), F.col(f"s{i}")).alias(f"s{i}") for i in range(len(versions))])

    def files(self, version: int) -> DataFrame:
        return self._states(version).filter("s0 IS NOT NULL").select("file", "s0.n_rows", "s0.deleted")

    def commit(self, base: int, added: DataFrame | None = None, removed: list[str] = (), deleted: DataFrame | None = None, processed: dict[str, int] | None = None, attach: dict[str, DataFrame] | None = None) -> int:
        """Adds rows, drops files, marks rows (file, row_index) deleted, saves ``attach``, all in one version.

        Writes only its own actions. Fails if another writer has committed ``base + 1`` meanwhile.
        """
        run = uuid.uuid4().hex
        nothing = F.array().cast("array<bigint>")
        actions = self.spark.createDataFrame([(f, None, [], True) for f in removed], f"{MANIFEST_SCHEMA}, removed boolean")
        if deleted is not None:
            marks = deleted.groupBy("file").agg(F.collect_set("row_index").alias("more"))
            grown = self.files(base).join(marks, "file").select("file", "n_rows", F.array_sort(F.array_union("deleted", "more")).alias("deleted"), F.lit(False).alias("removed"))
            actions = actions.unionByName(grown)
        if added is not None:
            target = f"{self.path}/data/run={run}"
            added.write.parquet(target)
            written = self.spark.read.schema(added.schema).parquet(target)
            new = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
            actions = actions.unionByName(new.withColumns({"deleted": nothing, "removed": F.lit(False)}))
        actions.write.parquet(f"{self.path}/log/run={run}")
        for name, df in (attach or {}).items():
            df.write.parquet(f"{self.path}/{name}/run={run}")
        before = self.commit_info(base)["processed"] if base >= 0 else {}
        self._publish(base + 1, json.dumps({"version": base + 1, "run": run, "processed": before | (processed or {})}), run)
        return base + 1

    def _publish(self, version: int, body: str, run: str) -> None:
        """Writes the commit file aside, hidden from readers, then renames it, which fails if the version exists."""
        aside, target = self._Path(f"{self.path}/commits/.{run}.json"), self._Path(f"{self.path}/commits/{version}.json")
        out = self._fs.create(aside, False)
        try:
            out.write(bytearray(body.encode()))
        finally:
            out.close()
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        never_over = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 1)
        never_over[0] = getattr(self._hadoop, "Options$Rename").NONE
        try:
            context.rename(context.makeQualified(aside), context.makeQualified(target), never_over)
        except Exception:
            self._fs.delete(aside, False)
            raise

    def _rows(self, entries: DataFrame, schema) -> DataFrame:
        """Rows of the files in ``entries`` with ``__file`` and ``__row``; folders are pruned by name while they are few."""
        if not self._exists("data"):
            return self.spark.createDataFrame([], schema).withColumns({"__file": F.lit(""), "__row": F.lit(0).cast("bigint")})
        run = F.regexp_extract("file", r"/run=([0-9a-f]+)/", 1)
        runs = [r[0] for r in entries.select(run.alias("r")).distinct().limit(LITERAL_RUNS + 1).collect()]
        full = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
        rows = self.spark.read.schema(full).parquet(f"{self.path}/data")
        if len(runs) <= LITERAL_RUNS:
            rows = rows.filter(F.col("run").isin(runs))
        names = entries.select(F.col("file").alias("__file"))
        located = rows.drop("run").withColumns({"__file": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")})
        return located.join(F.broadcast(names) if small_enough(names) else names, "__file", "left_semi")

    def read(self, schema, version: int | None = None) -> DataFrame:
        """Rows of a version without those in deletion vectors."""
        entries = self.files(self.version() if version is None else version)
        marks = entries.select(F.col("file").alias("__file"), F.explode("deleted").alias("__row"))
        return self._rows(entries, schema).join(marks, ["__file", "__row"], "left_anti").drop("__file", "__row")

    def changes(self, schema, since: int, upto: int) -> DataFrame:
        """Record deltas between two versions with ``_change`` insert or delete.

        Added files give inserts, removed files deletes, each without the rows their
        deletion vector masks at that version; vectors grown on kept files give deletes.
        Only folders with such files are read.
        """
        both = cut(self._states(since, upto))
        was, now = F.col("s0.deleted"), F.col("s1.deleted")
        out = None
        for keep, mask, kind, how in (
            (F.col("s0").isNull() & F.col("s1").isNotNull(), now, "insert", "left_anti"),
            (F.col("s1").isNull() & F.col("s0").isNotNull(), was, "delete", "left_anti"),
            (F.col("s0").isNotNull() & F.col("s1").isNotNull() & (F.size(F.array_except(now, was)) > 0), F.array_except(now, was), "delete", "left_semi"),
        ):
            entries = both.filter(keep)
            marks = entries.select(F.col("file").alias("__file"), F.explode(mask).alias("__row"))
            part = self._rows(entries, schema).join(marks, ["__file", "__row"], how).drop("__file", "__row").withColumn("_change", F.lit(kind))
            out = part if out is None else out.unionByName(part)
        return out


def process_new(source: VersionedTable, target: VersionedTable, name: str, schema, step: Callable[[DataFrame], DataFrame]) -> int:
    """One incremental run: the step sees only records changed since the last committed run.

    The processed source version is part of the output's own commit: a run that fails
    before it leaves nothing behind, one that fails after it isn't repeated. Without new
    versions nothing is written.
    """
    base, upto = target.version(), source.version()
    since = target.processed(name)
    if upto <= since:
        return base
    return target.commit(base, added=step(source.changes(schema, since, upto)), processed={name: upto})
