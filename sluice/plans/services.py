"""Queries of what stands around the data: decisions, states, checks and texts, as tables to compare with their SQL twins."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import config, locks, pipeline
from sluice.functions.order import OrderError, parse_terms
from sluice.operators import keys, ledger, merge, publish, rejects, validate
from sluice.operators import watermark as wm
from sluice.operators.contract import Contract, ContractColumn, ContractError, curated_gate, explain, null_violations, resolve_header, type_changes, version_violations
from sluice.plans import decks
from sluice.plans.ingestion import Query
from sluice.plans.landing import scratch_database
from sluice.session import table
from sluice.sources import intake, kafka, raw, sqltext
from sluice.sources.jdbc import JdbcSource, relation
from sluice.sources.sqltext import Projection

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


def _values(columns: str, *rows: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join(f'({r})' for r in rows)}) t({columns})"


def _table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _outcome(call, *errors: type[Exception]) -> str:
    """``ok``, or the code an error begins with."""
    try:
        call()
    except errors as e:
        return str(e).split()[0].rstrip(";:,")
    return "ok"


# watermarks


@query("SELECT DISTINCT run_id, replace(replace(coalesce(window_start, ''), '\\', '\\\\'), '|', '\\|') || '|' || replace(replace(run_id || '|x', '\\', '\\\\'), '|', '\\|') AS text, coalesce(window_start, '') AS first, run_id || '|x' AS second FROM ingest_run_audit WHERE run_id IS NOT NULL")
def watermark_codec(spark, root):
    """Values of several parts as one text and back, separators inside them escaped."""
    rows = table(spark, root, "ingest_run_audit").filter("run_id IS NOT NULL").selectExpr("run_id", "coalesce(window_start, '') AS first", "run_id || '|x' AS second").distinct()

    def both(batches):
        for b in batches:
            b = b.copy()
            b["text"] = [wm.serialize(pair) for pair in zip(b["first"], b["second"], strict=True)]
            parts = [wm.deserialize(t) for t in b["text"]]
            b["first"], b["second"] = [p[0] for p in parts], [p[1] for p in parts]
            yield b[["run_id", "text", "first", "second"]]

    return rows.mapInPandas(both, "run_id string, text string, first string, second string")


_PAIRS = (
    ("NUMERIC", "10", "9", 1), ("STRING", "10", "9", -1), ("NUMERIC", "1.50", "1.5", 0), ("DATE", "2024-02-01", "2024-01-31", 1), ("TIMESTAMP", "2024-01-01 00:00:00.1", "2024-01-01 00:00:00.09", 1),
    ("DATETIMEOFFSET", "2024-01-01 01:00:00 +01:00", "2024-01-01 00:00:00 +00:00", 0), ("ROWVERSION", "0x0A", "0B", -1), ("ROWVERSION", "00ff", "FF", 0),
)


@query(_values("kind, a, b, sign", *[f"'{k}', '{a}', '{b}', {s}" for k, a, b, s in _PAIRS]))
def watermark_typed_compare(spark, root):
    """Two texts of a kind, compared as what they stand for."""
    return _table(spark, "kind string, a string, b string, sign int", [(k, a, b, wm.compare(wm.WatermarkSpec(("c",), (k,)), (a,), (b,))) for k, a, b, _ in _PAIRS])


@query(_values("version, value, follows, refused", "1, '10', '', 'JDBC_005'", "2, '30', '10', 'JDBC_005'"))
def watermark_store_advances(spark, root):
    """A store that only advances: an older value changes nothing, a writer who saw another version is refused."""
    rows: list = []
    store = wm.WatermarkStore(lambda: spark.createDataFrame(rows, wm.STORE_SCHEMA), rows.append)
    spec = wm.WatermarkSpec(("id",), ("NUMERIC",))
    store.advance(spec, "e", ("10",), "r1", None)
    store.advance(spec, "e", ("9",), "r2", 1)
    refused = _outcome(lambda: store.advance(spec, "e", ("20",), "r3", None), wm.WatermarkError)
    store.advance(spec, "e", ("30",), "r4", 1)
    return spark.createDataFrame(rows, wm.STORE_SCHEMA).select(F.col("watermark_version").alias("version"), F.col("watermark_value").alias("value"), F.col("lower_value").alias("follows"), F.lit(refused).alias("refused"))


# landed batches


@query("SELECT d.day, d.run_id, CASE WHEN d.forced THEN 'APPEND' WHEN d.run_id IN (SELECT 'run_' || strftime(ts, '%Y-%m-%d') FROM events) THEN 'SKIP_RUN' WHEN NOT d.held AND d.day IN (SELECT strftime(ts, '%Y-%m-%d') FROM events) THEN 'SKIP_WINDOW' ELSE 'APPEND' END AS decision FROM (VALUES ('2024-01-05', 'new', false, false), ('2024-01-05', 'new', true, false), ('2024-01-05', 'run_2024-01-05', false, false), ('2024-01-05', 'run_2024-01-05', false, true), ('1999-01-01', 'old', false, false)) d(day, run_id, held, forced)")
def landing_decisions(spark, root):
    """Whether a run appends: not twice under one id, not a window that has landed unless it was held, always if forced."""
    landed = decks.landed_events(spark, root).withColumns({"extract_start_ts": F.col("ingest_dt"), "extract_end_ts": F.col("ingest_dt")})
    asked = [("2024-01-05", "new", False, False), ("2024-01-05", "new", True, False), ("2024-01-05", "run_2024-01-05", False, False), ("2024-01-05", "run_2024-01-05", False, True), ("1999-01-01", "old", False, False)]
    return _table(spark, "day string, run_id string, decision string", [(d, r, raw.decision(landed, r, (d, d), held, forced)) for d, r, held, forced in asked])


@query("SELECT event_id, source_file FROM (SELECT event_id, 'file_' || cast(event_id % 4 AS varchar) AS source_file, 'run_' || strftime(ts, '%Y-%m-%d') AS run_id FROM events) WHERE source_file = 'file_2' AND run_id = 'run_2024-01-05'")
def raw_slice_by_file(spark, root):
    """One file of a run."""
    landed = decks.landed_events(spark, root).withColumn("file_id", F.col("source_file"))
    return raw.slice_of(landed, run_id="run_2024-01-05", file_id="file_2").select("event_id", "source_file")


@query(_values("topic, partition, from_offset, until_offset", "'t', 0, cast(7 AS bigint), cast(12 AS bigint)", "'t', 1, -2, 3"))
def kafka_pinned_ranges(spark, root):
    """What a batch read of a topic takes: from what is committed to the ends as pinned; partitions without news are left out."""
    got = kafka.pinned_ranges({0: 7, 2: 5}, {0: 12, 1: 3, 2: 5, 3: 0})
    return _table(spark, "topic string, partition int, from_offset bigint, until_offset bigint", [("t", p, a, b) for p, (a, b) in got.items()])


# checks


@query("SELECT column_name, count(*) FILTER (v IS NULL) = count(*) AS all_null FROM (SELECT 'entity' AS column_name, entity AS v FROM documents UNION ALL SELECT 'nothing', NULL FROM documents UNION ALL SELECT 'lang', lang FROM documents) GROUP BY 1")
def all_null_columns(spark, root):
    df = table(spark, root, "documents").select("entity", "lang", F.lit(None).cast("string").alias("nothing"))
    empty = validate.all_null_columns(df, df.columns)
    return _table(spark, "column_name string, all_null boolean", [(c, c in empty) for c in df.columns])


@query(_values("case_name, outcome", "'gate', 'HDR_018'", "'version', 'HDR_014'", "'order column', 'HDR_019'", "'order text', 'HDR_020'", "'positions', 'HDR_008'", "'two owners', 'HDR_017'", "'no key in partition', 'CUR_006'", "'last write wins', 'CUR_008'", "'absence unconfirmed', 'CUR_005'", "'good', 'ok'"))
def refused_specifications(spark, root):
    """Specifications that would lose or confuse rows, by the code they are refused with."""
    orders = table(spark, root, "orders")
    c = Contract((ContractColumn("o_orderkey"), ContractColumn("absent")))
    cases = [
        ("gate", next((v.code for v in curated_gate(orders, c, ["o_orderkey"], [])), "ok")),
        ("version", next((v.code for v in version_violations(Contract((ContractColumn("a"), ContractColumn("b")), version="2"), {"ingest.schema.version": "1", "ingest.schema.required": "a"})), "ok")),
        ("order column", _outcome(lambda: keys.latest_per_key(orders, ["o_custkey"], "nope desc"), OrderError)),
        ("order text", _outcome(lambda: parse_terms("a upwards"), OrderError)),
        ("positions", _outcome(lambda: Contract((ContractColumn("a", position=1),), strategy="POSITION"), ContractError)),
        ("two owners", _outcome(lambda: Contract((ContractColumn("a", aliases=("b",)), ContractColumn("b"))), ContractError)),
        ("no key in partition", _outcome(lambda: merge.resolve_publish_mode("PARTITION_OVERWRITE", True, True, (), ("k",)), merge.MergeError)),
        ("last write wins", _outcome(lambda: merge.MergeSpec(keys=("k",), strategy="LAST_WRITE_WINS"), merge.MergeError)),
        ("absence unconfirmed", _outcome(lambda: merge.MergeSpec(keys=("k",), deletes="FULL_SNAPSHOT_ABSENCE"), merge.MergeError)),
        ("good", _outcome(lambda: merge.MergeSpec(keys=("k",), freshness="v"), merge.MergeError)),
    ]
    return _table(spark, "case_name string, outcome string", cases)


@query(_values("configured, incremental, there, mode", "NULL, true, true, 'MERGE'", "NULL, true, false, 'FULL_OVERWRITE'", "NULL, false, true, 'FULL_OVERWRITE'", "'merge', false, true, 'MERGE'", "'PARTITION_OVERWRITE', true, true, 'PARTITION_OVERWRITE'", "'PARTITION_OVERWRITE', true, false, 'FULL_OVERWRITE'"))
def publish_modes(spark, root):
    asked = [(None, True, True), (None, True, False), (None, False, True), ("merge", False, True), ("PARTITION_OVERWRITE", True, True), ("PARTITION_OVERWRITE", True, False)]
    return _table(spark, "configured string, incremental boolean, there boolean, mode string", [(c, i, t, merge.resolve_publish_mode(c, i, t, ("p",), ("k",))) for c, i, t in asked])


@query("SELECT limit_percent, 100.0 * n_bad / n_all > limit_percent AS refused FROM (SELECT count(*) AS n_all, count(*) FILTER (o_orderkey % 10 = 0) AS n_bad FROM orders), (VALUES (5), (50)) t(limit_percent)")
def reject_limits(spark, root):
    """A batch is refused when too many of its rows are."""
    n = table(spark, root, "orders").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderkey") % 10 == 0).alias("bad")).first()
    return _table(spark, "limit_percent int, refused boolean", [(p, _outcome(lambda p=p: rejects.check_limits(n.n, n.bad, max_percent=p), rejects.RejectLimitError) != "ok") for p in (5, 50)])


@query(_values("code, n", "'CFG_002', 1", "'CFG_005', 1", "'CFG_008', 1", "'CFG_013', 2", "'CFG_017', 1"))
def configuration_problems(spark, root):
    """All contradictions of a configuration at once."""
    conf = {
        "source": {"type": "file", "incremental": {"watermark": "x"}, "extraction": None},
        "raw": {"delivery_mode": "DEDUPLICATED_APPEND", "idempotency_key": ["run_id"]},
        "curated": {"strategy": "TYPE1_MERGE", "merge": {"freshness": {"tie_breakers": ["a sideways"]}}},
    }
    other = {"source": {"type": "jdbc", "extraction": {"strategy": "TIMESTAMP"}}, "raw": {"delivery_mode": "ONCE"}}
    rows = [(p.split()[0],) for p in [*config.problems(conf), *config.problems(other)]]
    return _table(spark, "code string", rows).groupBy("code").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query(_values("failure, kind, exit_code, again", "'lock', 'TRANSIENT', 10, true", "'reset', 'TRANSIENT', 10, true", "'state', 'TRANSIENT', 10, true", "'key', 'DATA_INTEGRITY', 20, false", "'setting', 'CONFIGURATION', 30, false", "'other', 'UNCLASSIFIED', 1, false"))
def failure_classes(spark, root):
    """What a failed run reports, and whether it may be tried again."""
    errors = {"lock": locks.LockError("x"), "reset": ConnectionResetError(), "state": RuntimeError("SQLState: 08006"), "key": publish.PublishError("x"), "setting": config.ConfigError("x"), "other": ValueError("x")}
    return _table(spark, "failure string, kind string, exit_code int, again boolean", [(n, c.name, c.exit_code, c.retryable) for n, e in errors.items() for c in [config.classify(e)]])


@query("SELECT header_id, n_exact, n_alias, n_unexpected FROM (SELECT header_id, count(*) FILTER (column_name = n) AS n_exact, count(*) FILTER (column_name <> n) AS n_alias, count(*) FILTER (column_name IS NULL) AS n_unexpected FROM (SELECT header_id, h.n, column_name FROM (SELECT header_id, entity, trim(regexp_replace(lower(unnest(string_split(actual_source_headers, ','))), '[^a-z0-9]+', '_', 'g'), '_') AS n FROM ingest_header_audit WHERE actual_source_headers IS NOT NULL AND entity = 'health_sherpa_member') h LEFT JOIN (SELECT DISTINCT column_name, trim(regexp_replace(lower(unnest(list_prepend(column_name, string_split(coalesce(aliases, ''), '|')))), '[^a-z0-9]+', '_', 'g'), '_') AS n FROM contract_column WHERE entity = 'health_sherpa_member') k USING (n)) GROUP BY 1)")
def mapping_explained(spark, root):
    """For each recorded header of the member feed how its columns were found: by name, by alias, or not."""
    rows = table(spark, root, "contract_column").filter("entity = 'health_sherpa_member'").orderBy("col_position").collect()
    contract = Contract(tuple(ContractColumn(r.column_name, aliases=tuple(a for a in (r.aliases or "").split("|") if a)) for r in rows))
    own = table(spark, root, "ingest_header_audit").filter("actual_source_headers IS NOT NULL AND entity = 'health_sherpa_member'").select("header_id", "actual_source_headers")

    def count(batches):
        for b in batches:
            found = [[k for _, _, k in explain(contract, resolve_header(contract, text.split(",")))] for text in b["actual_source_headers"]]
            b = b[["header_id"]].copy()
            for name, kind in (("n_exact", "EXACT"), ("n_alias", "ALIAS"), ("n_unexpected", "UNEXPECTED")):
                b[name] = [f.count(kind) for f in found]
            yield b

    return own.mapInPandas(count, "header_id bigint, n_exact bigint, n_alias bigint, n_unexpected bigint")


# texts for databases


@query(_values("dialect, top1, quoted", "'oracle', 'SELECT x FROM t FETCH FIRST 1 ROWS ONLY', '\"a b\"'", "'sqlserver', 'SELECT TOP 1 x FROM t', '[a b]'"))
def dialect_texts(spark, root):
    return _table(spark, "dialect string, top1 string, quoted string", [(n, d.top1("x", "FROM t"), d.quote("a b")) for n in ("sqlserver", "oracle") for d in [sqltext.dialect(n)]])


@query(_values("relation", "'(SELECT \"a\" AS \"x\", (b + 1) AS \"y\" FROM \"t\" WHERE (n > 5)) src'"))
def jdbc_projection_text(spark, root):
    """The query handed to a database: its own projection, filter and window."""
    s = JdbcSource("jdbc:x", mode="SELECT_QUERY", table="t", columns=(Projection("x", source="a"), Projection("y", expression="b + 1")))
    return _table(spark, "relation string", [(relation(s, "n > 5"),)])


# states


@query(_values("step, holder", "'r1 claims', 'r1'", "'r2 is refused', 'r1'", "'r1 falls silent', NULL", "'r2 takes over', 'r2'", "'r2 releases', NULL"))
def lease_holders(spark, root):
    """Who holds the lease of an entity, step by step."""
    events: list[locks.LockEvent] = []
    now = [1_000.0]
    lease = lambda r: locks.LeaseLock("e", r, lambda: list(events), events.append, minutes=3, settle_ms=0, clock=lambda: now[0], sleep=lambda s: None)
    r1, r2 = lease("r1"), lease("r2")
    held = lambda: locks.holder(events, "e", now[0], r1.beat_seconds)
    r1.acquire()
    steps = [("r1 claims", held())]
    now[0] += 10
    if _outcome(r2.acquire, locks.LockError) != "LCK_001":
        raise AssertionError("two runs hold one lease")
    steps.append(("r2 is refused", held()))
    now[0] += 10_000
    steps.append(("r1 falls silent", held()))
    r2.acquire()
    steps.append(("r2 takes over", held()))
    r2.release()
    steps.append(("r2 releases", held()))
    return _table(spark, "step string, holder string", steps)


@query("SELECT table_name FROM (VALUES ('__stg_t_new'), ('t')) v(table_name)")
def stale_staging_dropped(spark, root):
    """Staging tables a crashed run has left are dropped once they are old enough."""
    db = scratch_database(spark)
    for name, hours in (("t", 0), ("__stg_t_old", 30), ("__stg_t_new", 1)):
        spark.range(1).write.saveAsTable(f"{db}.{name}")
        made = int((dt.datetime.now().timestamp() - hours * 3_600) * 1_000)
        publish.set_properties(spark, f"{db}.{name}", {"sluice.staging.created_ms": str(made)})
    publish.drop_stale_staging(spark, f"{db}.t")
    return spark.sql(f"SHOW TABLES IN {db}").select(F.col("tableName").alias("table_name"))


@query(_values("file, status, code", "'a.csv', 'VALIDATED', ''", "'b.csv', 'SKIPPED', ''", "'blank.csv', 'FAILED', 'HDR_010'", "'delimiter.csv', 'FAILED', 'HDR_009'", "'encoding.csv', 'FAILED', 'HDR_012'", "'header.csv', 'SKIPPED', 'HDR_013'", "'missing.csv', 'FAILED', 'HDR_001'", "'quote.csv', 'FAILED', 'HDR_011'", "'twice.csv', 'FAILED', 'HDR_002'"))
def intake_states(spark, root):
    """What becomes of the files of a managed folder, and why."""
    contract = Contract((ContractColumn("subscriber_id"), ContractColumn("hios_id")))
    texts = {
        "a": b"subscriber_id,hios_id\nS1,H1\n", "b": b"subscriber_id,hios_id\nS1,H1\n", "header": b"subscriber_id,hios_id\n", "missing": b"subscriber_id,x\nS1,1\n", "twice": b"hios_id,hios_id\n1,2\n", "blank": b"\n1,2\n",
        "delimiter": b"subscriber_id;hios_id;x\n1;2;3\n", "quote": b'"subscriber_id,hios_id\n1,2\n', "encoding": b"subscriber_id,hios_id\n\xff\xfe,2\n",
    }
    with tempfile.TemporaryDirectory() as folder:  # the managed folder lies on the driver, as its operator does
        landing = Path(folder) / "landing"
        landing.mkdir()
        for name, text in texts.items():
            (landing / f"{name}.csv").write_bytes(text)
        got: list[tuple] = []
        intake.Intake(Path(folder), contract=contract, record=got.append).stage()
    code = lambda reason: next((w.rstrip(";") for w in reason.split() if w.startswith("HDR_")), "")
    return _table(spark, "file string, status string, code string", [(f, s, code(r)) for f, s, r in got])


@query("SELECT run_id, stage, status FROM (SELECT *, row_number() OVER (PARTITION BY run_id, stage ORDER BY event_ts DESC, (status <> 'STARTED') DESC, status DESC) AS n FROM ingest_run_audit WHERE entity = 'health_sherpa_member') WHERE n = 1 AND status = 'SUCCESS'")
def stages_to_skip_on_resume(spark, root):
    """Stages of the member feed's runs that a resumed run skips: those whose latest event is a success."""
    last = ledger.latest_status(table(spark, root, "ingest_run_audit").filter("entity = 'health_sherpa_member'"))
    return last.filter(F.col("status") == ledger.SUCCESS).select("run_id", "stage", "status")


@query(_values("case_name, shown", "'setting', 'password=*** host=h'", "'url', 'jdbc:x://***@h/d'", "'header', 'Authorization: *** ***'", "'json', '{\"apiKey\": ***, \"rows\": 5}'", "'plain', 'rows: 5 at 10:00'"))
def sanitized_messages(spark, root):
    """Messages as the ledger keeps them: without secrets."""
    said = {"setting": "password=p1 host=h", "url": "jdbc:x://ann:p1@h/d", "header": "Authorization: Bearer abcdefgh12", "json": '{"apiKey": "k", "rows": 5}', "plain": "rows: 5 at 10:00"}
    return _table(spark, "case_name string, shown string", [(n, ledger.sanitize(m)) for n, m in said.items()])


@query(_values("path, value, overridden", "'a.b', '3', true", "'a.c', '2', false", "'d', '4', false"))
def configuration_override(spark, root):
    """One configuration over another, path by path."""
    merged, changed, _ = config.override({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": 4})
    return _table(spark, "path string, value string, overridden boolean", [(p, str(config.get(merged, p)), p in changed) for p in config.paths(merged)])


@query(_values("case_name, committed", "'plain', true", "'rejects hold it', false", "'rejects pass', true", "'backfill', false", "'backfill that commits', true", "'dry run', false"))
def commit_gates(spark, root):
    """Whether a run commits its position."""
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    some = [rejects.RejectRule("one", "o_orderkey % 10 = 0", "R1", "x")]
    cases = {
        "plain": {}, "rejects hold it": {"reject_rules": some, "hold_on_rejects": True}, "rejects pass": {"reject_rules": some}, "backfill": {"conf": {"ingestion": {"pattern": "BACKFILL"}}},
        "backfill that commits": {"conf": {"ingestion": {"pattern": "BACKFILL", "watermark_commit": True}}}, "dry run": {},
    }
    db, out = scratch_database(spark), []
    for i, (name, options) in enumerate(cases.items()):
        done: list = []
        feed = pipeline.Feed("orders", lambda run_id: orders, f"{db}.raw{i}", f"{db}.curated{i}", f"{db}.runs{i}", spec=decks.MERGE, commit=done.append, **options)
        pipeline.run_feed(spark, feed, f"r{i}", dry_run=name == "dry run")
        out.append((name, bool(done)))
    return _table(spark, "case_name string, committed boolean", out)


@query(_values("step, holder, version", "'r1 takes it', 'r1', cast(1 AS bigint)", "'r2 is refused', 'r1', 1", "'r1 renews', 'r1', 2", "'r2 takes what has expired', 'r2', 3", "'r1 can not renew', 'r2', 3", "'r2 releases', NULL, 4"))
def database_lease(spark, root):
    """A lease in a row of a database, taken by compare-and-set."""
    url, now = f"jdbc:derby:memory:lease{uuid.uuid4().hex};create=true", [1_000.0]
    lease = lambda r: locks.DatabaseLease(spark, url, "e", r, minutes=1, clock=lambda: now[0], driver="org.apache.derby.jdbc.EmbeddedDriver")
    r1, r2, steps = lease("r1"), lease("r2"), []
    r1.create_table()

    def step(name: str, call, expected: object = None) -> None:
        if (got := _outcome(call, locks.LockError) if expected == "LCK_001" else call()) != expected:
            raise AssertionError(f"{name}: {got}")
        holder, _, version = r1._row()
        steps.append((name, holder, version))

    step("r1 takes it", r1.acquire)
    step("r2 is refused", r2.acquire, "LCK_001")
    step("r1 renews", r1.renew, True)
    now[0] += 120
    step("r2 takes what has expired", r2.acquire)
    step("r1 can not renew", r1.renew, False)
    step("r2 releases", r2.release)
    return _table(spark, "step string, holder string, version bigint", steps)


@query(_values("kind, code, policy", "'nullability', 'nullability_violation', 'FAIL'", "'type_change', 'type_change', 'FAIL'"))
def frame_violations(spark, root):
    """A frame against its contract: a column of another type, one that has nulls and must not."""
    df = table(spark, root, "documents").select("doc_id", "text", "n_chars")
    c = Contract((ContractColumn("doc_id", type="bigint", nullable=False), ContractColumn("text", nullable=False), ContractColumn("n_chars", type="date")))
    return _table(spark, "kind string, code string, policy string", [(v.kind, v.code, v.policy) for v in [*type_changes(c, df), *null_violations(c, df)]])
