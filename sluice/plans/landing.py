"""Queries that read files and databases, publish tables, run feeds and streams, each with its SQL twin.

Each works in a folder of its own beside the checkpoints and, where it needs tables, in a
database that lies there. What comes back is what a reader of the result would see.
"""

from __future__ import annotations

import uuid
import zipfile
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import pipeline
from sluice.operators import ledger, merge, publish, stamps
from sluice.operators import watermark as wm
from sluice.operators.contract import Contract, ContractColumn, header_violations
from sluice.operators.publish import Guards
from sluice.plans import decks
from sluice.plans.ingestion import MERGED_SQL, Query
from sluice.session import forget, shared_folder, table
from sluice.sources import files, jdbc, registry
from sluice.sources.sqltext import Filter, Projection
from sluice.streaming import microbatch

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its own name, with the SQL that must give the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


# files


def _written(df: DataFrame, name: str, header: bool = True, by: str | None = None) -> str:
    folder = shared_folder(df.sparkSession, name)
    w = df.write.option("header", header)
    (w.partitionBy(by) if by else w).csv(folder)
    return folder


@query("SELECT cast(c_custkey AS varchar) AS c_custkey, c_name, c_mktsegment FROM customer")
def file_scan_csv(spark, root):
    """A folder of delimited files; every column is text."""
    folder = _written(table(spark, root, "customer").select("c_custkey", "c_name", "c_mktsegment"), "csv")
    return registry.SOURCES.get("file")(spark, path=folder).drop("source_file")


@query("SELECT o_orderstatus AS folder, count(*) AS n_rows FROM orders GROUP BY 1")
def file_scan_origin(spark, root):
    """Each row knows its file."""
    folder = _written(table(spark, root, "orders").select("o_orderkey", "o_orderstatus"), "origin", by="o_orderstatus")
    rows = files.read_files(spark, folder)
    return rows.groupBy(F.regexp_extract("source_file", "o_orderstatus=([^/]*)/", 1).alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT cast(o_orderkey AS varchar) AS o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')")
def file_scan_pattern(spark, root):
    """Files by a pattern, or by explicit paths, which win over it."""
    folder = _written(table(spark, root, "orders").select("o_orderkey", "o_orderstatus"), "pattern", by="o_orderstatus")
    by_pattern = registry.SOURCES.get("FILE")(spark, path=f"{folder}/o_orderstatus={{F,X}}")
    by_paths = registry.SOURCES.get("file")(spark, path=f"{folder}/*", paths=[f"{folder}/o_orderstatus=P"])
    return by_pattern.select("o_orderkey").unionByName(by_paths.select("o_orderkey"))


_LAYOUTS = Contract((ContractColumn("item_key", aliases=("s suppkey", "part-key")), ContractColumn("item_name", aliases=("s_name", "NAME")), ContractColumn("brand", required=False, default="none")))


@query("SELECT cast(s_suppkey AS varchar) AS item_key, s_name AS item_name, 'none' AS brand FROM supplier UNION ALL SELECT cast(p_partkey AS varchar), p_name, p_brand FROM part")
def file_grouped_layouts(spark, root):
    """Files whose headers differ in names, order and number of columns, under one contract."""
    suppliers = _written(table(spark, root, "supplier").select("s_suppkey", "s_name"), "suppliers")
    parts = _written(table(spark, root, "part").select(F.col("p_name").alias("Name"), F.col("p_brand").alias("BRAND"), F.col("p_partkey").alias("Part Key")), "parts")
    return files.read_grouped(spark, {suppliers: ["s_suppkey", "s_name"], parts: ["Name", "BRAND", "Part Key"]}, _LAYOUTS).drop("source_file")


@query("SELECT cast(n_nationkey AS varchar) AS nation_key, n_name AS nation_name, cast(n_regionkey AS varchar) AS region_key FROM nation")
def file_columns_by_position(spark, root):
    """Files without header: the contract's positions name the columns."""
    folder = _written(table(spark, root, "nation").select("n_nationkey", "n_name", "n_regionkey"), "position", header=False)
    c = Contract(tuple(ContractColumn(n, position=i) for i, n in enumerate(("nation_key", "nation_name", "region_key"))), strategy="POSITION")
    return files.map_columns(files.read_files(spark, folder, files.FileFormat(header=False), stamp=False), c)


@query("SELECT cast(n_nationkey AS varchar) AS nation_key, n_name AS nation_name FROM nation")
def file_columns_by_position_fallback(spark, root):
    """A header that names nothing required is taken by position where the contract allows it."""
    folder = _written(table(spark, root, "nation").select(F.col("n_nationkey").alias("col1"), F.col("n_name").alias("col2")), "fallback")
    c = Contract((ContractColumn("nation_key", position=0), ContractColumn("nation_name", position=1)), strategy="NAME_ALIAS_POSITION_FALLBACK")
    return files.map_columns(files.read_files(spark, folder, stamp=False), c)


@query("SELECT cast(c_custkey AS varchar) AS id, c_mktsegment FROM customer")
def file_legacy_columns(spark, root):
    folder = _written(table(spark, root, "customer").select(F.col("c_custkey").alias("Cust No."), "c_name", "c_mktsegment"), "legacy")
    return files.legacy_columns(files.read_files(spark, folder, stamp=False), {"cust no": "id"}, ["id", "C_MKTSEGMENT"])


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS a, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey DESC) AS z FROM orders) WHERE a > 2 AND z > 1")
def file_edges_dropped(spark, root):
    """The first two and the last line of each file."""
    lines = table(spark, root, "orders").select("o_orderkey", "o_orderstatus").repartition("o_orderstatus").sortWithinPartitions("o_orderstatus", "o_orderkey")
    folder = _written(lines, "edges", header=False, by="o_orderstatus")
    rows = files.without_edges(files.read_files(spark, folder, files.FileFormat(header=False)), 2, 1)
    return rows.select(F.col("_c0").cast("bigint").alias("o_orderkey"))


@query("""WITH p AS (SELECT header_id, entity, unnest(string_split(actual_source_headers, ',')) AS h, unnest(range(len(string_split(actual_source_headers, ',')))) AS i FROM ingest_header_audit WHERE actual_source_headers IS NOT NULL),
 n AS (SELECT *, trim(regexp_replace(lower(trim(h)), '[^a-z0-9]+', '_', 'g'), '_') AS n FROM p),
 names AS (SELECT entity, column_name, col_position, is_required, trim(regexp_replace(lower(trim(unnest(list_prepend(column_name, string_split(coalesce(aliases, ''), '|'))))), '[^a-z0-9]+', '_', 'g'), '_') AS n FROM contract_column),
 known AS (SELECT DISTINCT entity, column_name, col_position, n FROM names WHERE n <> ''),
 m AS (SELECT n.*, column_name, col_position FROM n LEFT JOIN known USING (entity, n)),
 hs AS (SELECT DISTINCT header_id, entity FROM p),
 named AS (SELECT header_id, column_name, count(DISTINCT h) AS k FROM m WHERE column_name IS NOT NULL GROUP BY 1, 2),
 o AS (SELECT header_id, list(column_name ORDER BY i) AS was, list_distinct(list(column_name)) AS cols FROM m WHERE col_position IS NOT NULL GROUP BY 1),
 e AS (SELECT header_id, list(column_name ORDER BY col_position) AS want FROM (SELECT DISTINCT header_id, column_name, col_position FROM m WHERE col_position IS NOT NULL) GROUP BY 1)
 SELECT header_id, 'HDR_002' AS code, count(*) AS n_found FROM (SELECT header_id, h FROM p GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1
 UNION ALL SELECT header_id, 'HDR_010', count(DISTINCT h) FROM n WHERE n = '' GROUP BY 1
 UNION ALL SELECT header_id, 'HDR_003', count(*) FROM (SELECT header_id, n FROM n WHERE n <> '' GROUP BY 1, 2 HAVING count(DISTINCT h) > 1) GROUP BY 1
 UNION ALL SELECT header_id, 'HDR_005', count(*) FROM named WHERE k > 1 GROUP BY 1
 UNION ALL SELECT hs.header_id, 'HDR_001', count(*) FROM hs JOIN contract_column c USING (entity) LEFT JOIN named ON named.header_id = hs.header_id AND named.column_name = c.column_name WHERE c.is_required AND named.k IS NULL GROUP BY 1
 UNION ALL SELECT header_id, 'HDR_006', count(*) FROM m WHERE column_name IS NULL AND n <> '' GROUP BY 1
 UNION ALL SELECT o.header_id, 'order_change', 1 FROM o JOIN e USING (header_id) WHERE was <> want""")
def header_violation_counts(spark, root):
    """Every recorded header against its entity's contract: how often each code is violated."""
    found = header_violations(table(spark, root, "ingest_header_audit"), _contracts(spark, root), "header_id", "entity", "actual_source_headers")
    return found.groupBy("header_id", "code").agg(F.count(F.lit(1)).alias("n_found"))


def _contracts(spark: SparkSession, root: str, cap: int = 10_000) -> dict[str, Contract]:
    """Contracts as configuration; refuses a table beyond ``cap`` rows."""
    got = table(spark, root, "contract_column").limit(cap + 1).collect()
    if len(got) > cap:
        raise ValueError(f"more than {cap} contract columns")
    out: dict[str, list] = {}
    for r in sorted(got, key=lambda r: (r.entity, r.col_position)):
        out.setdefault(r.entity, []).append(ContractColumn(r.column_name, aliases=tuple(a for a in (r.aliases or "").split("|") if a), position=r.col_position, required=bool(r.is_required)))
    return {e: Contract(tuple(c)) for e, c in out.items()}


# tables


def scratch_database(spark: SparkSession) -> str:
    """A database of its own that lies beside the checkpoints."""
    name = f"sluice_{uuid.uuid4().hex[:16]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(spark, 'database')}'")
    return name


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 10 <> 0")
def publish_staged(spark, root):
    """A table replaced by rows that read it; a batch that would shrink it too much, or repeats keys, leaves it as it is."""
    name = f"{scratch_database(spark)}.t"
    publish.publish(table(spark, root, "orders").select("o_orderkey", "o_totalprice"), name)
    guards = Guards(unique_keys=("o_orderkey",), max_shrink_percent=20.0, validation_query="SELECT 1 FROM {table} WHERE o_orderkey IS NULL")
    publish.publish(spark.table(name).filter("o_orderkey % 10 <> 0"), name, guards)
    for bad in (spark.table(name).filter("o_orderkey % 2 = 0"), spark.table(name).unionByName(spark.table(name).filter("o_orderkey % 7 = 1"))):
        try:
            publish.publish(bad, name, guards)
        except publish.PublishError:
            continue
        raise AssertionError("a guard let a bad batch pass")
    return spark.table(name)


@query("SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority <> '2-HIGH'")
def publish_partitions(spark, root):
    """Partitions in the batch are replaced, emptied ones dropped, all others left alone."""
    name = f"{scratch_database(spark)}.t"
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    publish.publish(orders, name, partitions=("o_orderpriority",))
    touched = orders.filter("o_orderpriority IN ('1-URGENT', '2-HIGH')").select("o_orderpriority").distinct()
    written = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.lit("X"))
    publish.publish(written, name, partitions=("o_orderpriority",), scoped=True)
    publish.drop_partitions(spark, name, merge.emptied_partitions(touched, written))
    return spark.table(name)


@query("SELECT event_id, event_type, NULL AS run_id FROM events UNION ALL SELECT event_id, event_type, 'r2' FROM events WHERE event_id % 3 = 0")
def raw_append_widened(spark, root):
    """The second batch brings a metadata column: the table is widened, older rows hold null."""
    name = f"{scratch_database(spark)}.raw"
    events = table(spark, root, "events").select("event_id", "event_type")
    publish.append_raw(events, name)
    later = events.filter("event_id % 3 = 0").select("event_type", F.col("event_id").alias("EVENT_ID"), F.lit("r2").alias("run_id"))
    publish.append_raw(later, name, metadata=("run_id",), on_missing_metadata="ALTER")
    return spark.table(name)


@query("SELECT * FROM (VALUES ('r1', 'raw', 'SUCCESS', cast(5 AS bigint), cast(NULL AS varchar)), ('r2', 'raw', 'FAILED', NULL, 'late')) t(run_id, stage, status, n, note)")
def control_table_migrated(spark, root):
    """A control table written by an older version gets the columns it lacks."""
    name = f"{scratch_database(spark)}.control"
    publish.append_control(spark, name, "run_id string, stage string, status string, n bigint", [("r1", "raw", "SUCCESS", 5)])
    publish.append_control(spark, name, "run_id string, stage string, status string, n bigint, note string", [("r2", "raw", "FAILED", None, "late")])
    return spark.table(name)


@query("SELECT * FROM (VALUES ('schema.version', '2'), ('schema.required', 'a,b')) t(name, value)")
def table_properties(spark, root):
    name = f"{scratch_database(spark)}.t"
    publish.append_raw(table(spark, root, "region"), name)
    publish.set_properties(spark, name, {"schema.version": "1", "schema.required": "a,b"})
    if not publish.set_properties(spark, name, {"schema.version": "2"}) or publish.set_properties(spark, name, {"schema.version": "2"}):
        raise AssertionError("properties are recorded when they change, and only then")
    return spark.sql(f"SHOW TBLPROPERTIES {name}").filter("key LIKE 'schema.%'").select(F.col("key").alias("name"), "value")


@query("SELECT event_id, event_type, 'r7' AS last_modified_run_id FROM events")
def technical_columns_dropped(spark, root):
    """Technical source columns go, the run is stamped where the table has its column."""
    rows = table(spark, root, "events").select("event_id", "event_type", F.lit(3).alias("kafka_partition"), F.lit(None).cast("string").alias("last_modified_run_id"))
    stamped = stamps.stamp_audit(stamps.drop_technical(rows), F.lit("2024-01-01").cast("timestamp_ntz"), "r7")
    return stamped.select("event_id", "event_type", "last_modified_run_id")


# runs


def _orders_feed(spark: SparkSession, root: str, batches: list[DataFrame], **options) -> pipeline.Feed:
    db, coming = scratch_database(spark), iter(batches)
    given = dict(entity="orders", read=lambda run_id: next(coming), raw_table=f"{db}.raw", curated_table=f"{db}.curated", ledger_table=f"{db}.runs", spec=decks.MERGE)
    return pipeline.Feed(**(given | options))


def _current(spark: SparkSession, feed: pipeline.Feed) -> DataFrame:
    return spark.table(feed.curated_table).select("o_custkey", "o_orderkey", "o_orderdate")


def _two_batches(spark: SparkSession, root: str) -> list[DataFrame]:
    return [decks.target_orders(spark, root), decks.arriving_orders(spark, root)]


_CURRENT = f"WITH {MERGED_SQL} SELECT o_custkey, o_orderkey, o_orderdate FROM merged WHERE o_custkey IS NOT NULL"


@query(_CURRENT)
def run_two_batches(spark, root):
    """Two runs of a feed: landed, curated, reconciled; the second merges into what the first has left."""
    feed = _orders_feed(spark, root, _two_batches(spark, root))
    for run_id in ("r1", "r2"):
        pipeline.run_feed(spark, feed, run_id)
    return _current(spark, feed)


@query(f"""WITH {MERGED_SQL}, first AS (SELECT count(*) AS n FROM tgt WHERE o_custkey IS NOT NULL), n AS (SELECT count(*) AS n FROM arriving), k AS (SELECT outcome, count(*) AS n FROM merged GROUP BY 1)
 SELECT 'r1' AS run_id, 'raw' AS stage, 'SUCCESS' AS status, n AS accepted, -1 AS inserted, -1 AS updated FROM first UNION ALL SELECT 'r1', 'curated', 'SUCCESS', n, n, 0 FROM first
 UNION ALL SELECT 'r2', 'raw', 'SUCCESS', n, -1, -1 FROM n UNION ALL SELECT 'r2', 'curated', 'SUCCESS', n, coalesce((SELECT n FROM k WHERE outcome = 'inserted'), 0), coalesce((SELECT n FROM k WHERE outcome = 'updated'), 0) FROM n""")
def run_ledger_counts(spark, root):
    """What the ledger says of the two runs."""
    feed = _orders_feed(spark, root, _two_batches(spark, root))
    for run_id in ("r1", "r2"):
        pipeline.run_feed(spark, feed, run_id)
    ended = spark.table(feed.ledger_table).filter("status <> 'STARTED'")
    return ended.select("run_id", "stage", "status", F.col("accepted_count").alias("accepted"), F.col("insert_count").alias("inserted"), F.col("update_count").alias("updated"))


@query(f"""WITH {MERGED_SQL}, n AS (SELECT count(*) AS n, count(*) FILTER (o_custkey IS NULL) AS blank FROM arriving)
 SELECT name, cast(n AS varchar) AS expected, cast(n AS varchar) AS actual, true AS passed FROM n, (VALUES ('source_equals_accepted_plus_rejected'), ('raw_equals_accepted'), ('curated_accounts_for_accepted_rows')) t(name)""")
def reconcile_identity(spark, root):
    """The identities a run has to satisfy, as checked by the run that merges the arriving orders."""
    feed = _orders_feed(spark, root, _two_batches(spark, root))
    pipeline.run_feed(spark, feed, "r1")
    checks = pipeline.run_feed(spark, feed, "r2")[1]
    return spark.createDataFrame([(c.name, c.expected, c.actual, c.passed) for c in checks], "name string, expected string, actual string, passed boolean")


def _fails_to_curate(spark: SparkSession, feed: pipeline.Feed, run_id: str) -> pipeline.Feed:
    """Runs the feed until its curated stage fails, as it does with a cast that would lose values."""
    try:
        pipeline.run_feed(spark, replace(feed, types={"o_orderstatus": "date"}), run_id)
    except pipeline.PipelineError:
        return feed
    raise AssertionError("the cast should have been refused")


@query(_CURRENT)
def run_window_landed_before(spark, root):
    """A run lands its window and fails; the next one over the same window lands nothing and curates what has landed."""
    first, second = _two_batches(spark, root)
    windows = {"r1": ("", ""), "r2": ("2001-01-01", "2001-02-01"), "r3": ("2001-01-01", "2001-02-01")}
    feed = _orders_feed(spark, root, [first, second, second], window=windows.get)
    pipeline.run_feed(spark, feed, "r1")
    _fails_to_curate(spark, feed, "r2")
    pipeline.run_feed(spark, feed, "r3")
    return _current(spark, feed)


@query(_CURRENT)
def run_resumed(spark, root):
    """A failed run is resumed under its own id: the landed stage is skipped, the curated one done."""
    feed = _orders_feed(spark, root, _two_batches(spark, root))
    pipeline.run_feed(spark, feed, "r1")
    _fails_to_curate(spark, feed, "r2")
    pipeline.run_feed(spark, feed, "r2", resume=True)
    return _current(spark, feed)


@query(_CURRENT)
def run_pending_batches(spark, root):
    """Batches that landed and were not curated, in the order they landed; one of them has failed before."""
    feed = _orders_feed(spark, root, _two_batches(spark, root))
    pipeline.land(pipeline.Run(spark, feed, "r1"))
    _fails_to_curate(spark, feed, "r2")
    got = pipeline.drive_batches(spark, feed, "pending")
    if [r for r, s in got if s == ledger.SUCCESS] != ["r1", "r2"]:
        raise AssertionError(str(got))
    return _current(spark, feed)


@query(f"WITH {MERGED_SQL} SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM merged")
def stream_files_merge(spark, root):
    """Arriving orders as a stream of files in several micro-batches, merged into a table; the stream is started again in the end and finds nothing."""
    name, source = f"{scratch_database(spark)}.t", shared_folder(spark, "stream")
    columns = ["o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority"]
    publish.publish(decks.target_orders(spark, root).select(*columns), name)
    arriving = decks.arriving_orders(spark, root).select(*columns)
    arriving.repartition(3, "o_orderkey").write.parquet(source)
    sink, seen = microbatch.MicroBatchMerge(name, decks.MERGE), []
    stream = spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):
        started = microbatch.start(stream, replace(sink, on_counts=lambda run_id, counts: seen.append(run_id)), f"{source}-position", available_now=True)
        started.awaitTermination()
    if len(set(seen)) != len(seen):
        raise AssertionError(f"batches came twice: {seen}")
    return spark.table(name)


# databases


#: What the embedded database's "orders" holds; pages are filled, since nothing is changed later.
_ORDERS = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "VARCHAR(8)", "o_orderpriority": "VARCHAR(32)"}
_PAGES = {"pageSize": 16_384, "pageReservedSpace": 0}


def _local(spark: SparkSession, folder: str) -> Path:
    """A shared folder as every process sees it; an embedded database opens files by path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder).toUri()
    if at.getScheme() not in (None, "file"):
        raise RuntimeError(f"an embedded database needs a shared folder with a path, not {at.getScheme()}")
    return Path(at.getPath())


def _database(spark: SparkSession, root: str) -> str:
    """Orders in an embedded database of its own; returns its URL.

    Only one process can open a database folder, and one in memory is seen by the process
    alone that made it. So the driver loads it, shuts it down and packs it into an archive,
    which driver and executors read at once.
    """
    return archived_database(spark, table(spark, root, "orders").select(*_ORDERS), "orders", _ORDERS)


def archived_database(spark: SparkSession, rows: DataFrame, name: str, columns: dict[str, str]) -> str:
    """A read-only database with one table, beside the checkpoints; returns its URL.

    The rows come as lines in which texts are quoted and nulls aren't, so that nothing is trimmed and no empty text gets lost.
    """
    jvm, folder = spark._jvm, shared_folder(spark, "jdbc")
    cells = [F.concat(F.lit('"'), F.replace(n, F.lit('"'), F.lit('""')), F.lit('"')) if kind == "string" else F.col(n).cast("string") for n, kind in rows.select(*columns).dtypes]
    lines = rows.select(F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells]))
    lines.coalesce(1).write.text(f"{folder}/rows")
    base = _local(spark, folder)
    text, db, archive = next((base / "rows").glob("part-*"), None), base / "db", base / "db.jar"
    jvm.java.lang.System.setProperty("derby.stream.error.field", "java.lang.System.err")
    jvm.java.lang.Class.forName("org.apache.derby.jdbc.EmbeddedDriver")
    c = jvm.java.sql.DriverManager.getConnection(f"jdbc:derby:{db};create=true")
    try:
        run = c.createStatement().execute
        for k, v in _PAGES.items():
            run(f"CALL SYSCS_UTIL.SYSCS_SET_DATABASE_PROPERTY('derby.storage.{k}', '{v}')")
        run(f'CREATE TABLE "{name}" ({", ".join(f'"{n}" {t}' for n, t in columns.items())})')
        if text:
            quoted = str(text).replace("'", "''")
            run(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{name}', '{quoted}', NULL, NULL, 'UTF-8', 0)")
    finally:
        c.close()
        _shut_down(jvm, f"jdbc:derby:{db}")
    forget(spark, f"{folder}/rows")
    _pack(db, archive)
    forget(spark, f"{folder}/db")
    return f"jdbc:derby:jar:({archive})db"


def _shut_down(jvm, url: str) -> None:
    """Derby says by an exception, SQLSTATE 08006, that a database has been shut down."""
    try:
        jvm.java.sql.DriverManager.getConnection(f"{url};shutdown=true")
    except Exception as e:
        if not any(f.state == "08006" for f in jdbc.sql_failures(e)):
            raise


def _pack(folder: Path, archive: Path, piece: int = 64 << 20) -> None:
    """Moves a folder's files into an archive, uncompressed, so that pages are found by seeking; needs no room for a second copy.

    Each file is cut into pieces from its end on, then appended piece by piece.
    """
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(p for p in folder.rglob("*") if p.is_file()):
            entry = zipfile.ZipInfo(f"{folder.name}/{f.relative_to(folder)}")
            entry.file_size = f.stat().st_size
            starts = range(0, entry.file_size, piece)
            for at in reversed(starts):
                with f.open("r+b") as whole:
                    whole.seek(at)
                    Path(f"{f}.{at}").write_bytes(whole.read())
                    whole.truncate(at)
            with z.open(entry, "w") as out:
                for at in starts:
                    part = Path(f"{f}.{at}")
                    out.write(part.read_bytes())
                    part.unlink()


def _source(spark: SparkSession, root: str, **options) -> jdbc.JdbcSource:
    return jdbc.JdbcSource(_database(spark, root), dialect_name="derby", **options)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def jdbc_full_table(spark, root):
    s = _source(spark, root, table="orders")
    jdbc.health_check(spark, s, executors=True)
    return jdbc.read(spark, s)


@query("SELECT o_orderkey AS id, o_custkey * 2 AS twice FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_custkey >= 10")
def jdbc_select_query(spark, root):
    """Projection and filters are the database's work."""
    columns = (Projection("id", source="o_orderkey"), Projection("twice", expression='"o_custkey" * 2'))
    return jdbc.read(spark, _source(spark, root, mode="SELECT_QUERY", table="orders", columns=columns, filters=(Filter("o_orderstatus", "IN", ["F", "O"]), Filter("o_custkey", ">=", 10, "NUMBER"))))


@query("SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY 1")
def jdbc_custom_sql(spark, root):
    return jdbc.read(spark, _source(spark, root, mode="CUSTOM_SQL", sql='SELECT "o_orderstatus", CAST(COUNT(*) AS BIGINT) AS "n_orders" FROM "orders" GROUP BY "o_orderstatus"'))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 100")
def jdbc_template(spark, root):
    return jdbc.read(spark, _source(spark, root, mode="SQL_TEMPLATE", sql='SELECT "o_orderkey", "o_custkey" FROM "orders" WHERE "o_orderkey" > :least'), parameters={"least": "100"})


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def jdbc_range_partitions(spark, root):
    """Read in eight ranges between the bounds found in the database."""
    df = jdbc.read(spark, _source(spark, root, table="orders", partition_column="o_orderkey", partitions=8, discover_bounds=True))
    if df.rdd.getNumPartitions() != 8:
        raise AssertionError("the read isn't partitioned")
    return df


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'O')")
def jdbc_predicates(spark, root):
    return jdbc.read(spark, _source(spark, root, table="orders", predicates=("\"o_orderstatus\" = 'F'", "\"o_orderstatus\" = 'O'")))


def _memory_store(spark: SparkSession) -> wm.WatermarkStore:
    rows: list = []
    return wm.WatermarkStore(lambda: spark.createDataFrame(rows, wm.STORE_SCHEMA), rows.append)


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'seed' ELSE 'window' END AS part FROM orders WHERE o_orderstatus = 'F' OR o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F')")
def jdbc_seed_then_windows(spark, root):
    """A full load seeds the watermark; the first window starts behind it, the second finds nothing, a second full load changes nothing."""
    spec, store = wm.WatermarkSpec(("o_orderkey",), ("NUMERIC",)), _memory_store(spark)
    source = _source(spark, root, table="orders", watermark=spec, filters=(Filter("o_orderstatus", "=", "F"),))
    full = jdbc.IncrementalReader(spark, source, store, "orders")
    parts = [full.read("r1").select("o_orderkey", F.lit("seed").alias("part"))]
    full.commit("r1")
    windows = jdbc.IncrementalReader(spark, replace(source, mode="INCREMENTAL", filters=()), store, "orders")
    for run_id in ("r2", "r3"):
        parts.append(windows.read(run_id).select("o_orderkey", F.lit("window").alias("part")))
        windows.commit(run_id)
    full.read("r4")
    if full.commit("r4"):
        raise AssertionError("a watermark was seeded twice")
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT count(*) AS n_rows, min(o_orderkey) AS least, max(o_orderkey) AS greatest, cast(max(o_orderkey) AS varchar) AS captured FROM orders WHERE o_orderpriority = '1-URGENT'")
def jdbc_captured_bound(spark, root):
    """The bound captured for a window respects the source's filters."""
    source = _source(spark, root, mode="INCREMENTAL", table="orders", watermark=wm.WatermarkSpec(("o_orderkey",), ("NUMERIC",)), filters=(Filter("o_orderpriority", "=", "1-URGENT"),))
    upper = jdbc.capture_upper(spark, source)
    rows = jdbc.read(spark, source, wm.upper_sql(source.watermark, upper, source.dialect.quote)) if upper else jdbc.read(spark, source, "1 = 0")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("greatest")).withColumn("captured", F.lit(upper[0] if upper else None).cast("string"))
