import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from sluice import config, locks, pipeline
from sluice.operators import ledger, merge, publish
from sluice.operators.contract import Contract, ContractColumn
from sluice.operators.merge import MergeSpec
from sluice.operators.publish import Guards, PublishError
from sluice.operators.rejects import RejectRule
from sluice.streaming import microbatch

SPEC = MergeSpec(keys=("claim_id",), freshness="modified_ts", compare_as="timestamp")


@pytest.fixture
def db(spark, request):
    name = "t_" + request.node.name.replace("[", "_").replace("]", "").lower()[:40]
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def claims(spark, *rows):
    return spark.createDataFrame(list(rows), "claim_id string, amount string, modified_ts string")


def content(spark, table, *cols):
    return sorted(tuple(r) for r in spark.table(table).select(*cols).collect())


def test_publish_replaces_or_refuses(spark, db):
    t = f"{db}.t"
    assert publish.publish(spark.range(10), t) == 10
    assert publish.publish(spark.table(t).filter("id < 9"), t) == 9
    for guards in (Guards(expected_count=5), Guards(max_shrink_percent=20.0), Guards(validation_query="SELECT 1 FROM {table} WHERE id = 0")):
        with pytest.raises(PublishError):
            publish.publish(spark.range(7), t, guards)
    with pytest.raises(PublishError, match="empty"):
        publish.publish(spark.range(0), t)
    with pytest.raises(PublishError, match="more than once"):
        publish.publish(spark.range(9).union(spark.range(1)), t, Guards(unique_keys=("id",)))
    with pytest.raises(PublishError, match="identifier"):
        publish.publish(spark.range(1), "a; DROP")
    assert spark.table(t).count() == 9 and [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect()] == ["t"]
    assert publish.set_properties(spark, t, {"a": "1"}) and not publish.set_properties(spark, t, {"a": "1"})


def test_scoped_publish_leaves_other_partitions_files_alone(spark, db):
    t = f"{db}.p"
    publish.publish(spark.range(9).selectExpr("id", "cast(id % 3 AS string) AS part"), t, partitions=("part",))
    files = lambda part: sorted(r.f for r in spark.table(t).filter(f"part = '{part}'").select(F.input_file_name().alias("f")).distinct().collect())
    before = files("0"), files("1")
    publish.publish(spark.createDataFrame([(100, "1")], "id bigint, part string"), t, partitions=("part",), scoped=True)
    assert files("0") == before[0] and files("1") != before[1] and content(spark, t, "id") == [(0,), (2,), (3,), (5,), (6,), (8,), (100,)]
    assert publish.drop_partitions(spark, t, spark.createDataFrame([("2",)], "part string")) == 1 and spark.table(t).count() == 4
    with pytest.raises(PublishError, match="more than 0"):
        publish.drop_partitions(spark, t, spark.createDataFrame([("2",)], "part string"), cap=0)


def test_stale_staging_is_dropped(spark, db):
    for name, age in (("__stg_t_old", 30), ("__stg_t_new", 1)):
        spark.range(1).write.saveAsTable(f"{db}.{name}")
        at = int((dt.datetime.now().timestamp() - age * 3600) * 1000)
        spark.sql(f"ALTER TABLE {db}.{name} SET TBLPROPERTIES ('sluice.staging.created_ms' = '{at}')")
    assert publish.drop_stale_staging(spark, f"{db}.t") == [f"{db}.__stg_t_old"]


def test_raw_append_policies(spark, db):
    t = f"{db}.r"
    publish.append_raw(spark.range(2), t)
    publish.append_raw(spark.range(2).selectExpr("id AS ID"), t)
    wide = spark.range(1).withColumn("run_id", F.lit("r"))
    with pytest.raises(PublishError, match="RAW_001"):
        publish.append_raw(wide, t, metadata=("run_id",))
    publish.append_raw(wide, t, metadata=("run_id",), on_missing_metadata="WARN")
    publish.append_raw(wide, t, metadata=("run_id",), on_missing_metadata="ALTER")
    assert spark.table(t).count() == 6 and spark.table(t).filter("run_id = 'r'").count() == 1
    with pytest.raises(PublishError, match="lacks columns run_id"):
        publish.append_raw(spark.range(1), t)


def feed(spark, db, batches, **k):
    seen = iter(batches)
    d = dict(entity="claims", read=lambda run_id: next(seen), raw_table=f"{db}.raw_claims", curated_table=f"{db}.claims", ledger_table=f"{db}.runs", spec=SPEC, rejects_table=f"{db}.rejects", reject_rules=[RejectRule("amount", "try_cast(amount AS int) IS NULL", "R1", "amount")])
    return pipeline.Feed(**(d | k))


FIRST = [("C1", "100", "2026-01-01 09:00:00"), ("C2", "200", "2026-01-02 09:00:00"), ("C2", "150", "2026-01-01 09:00:00"), ("C3", "x", "2026-01-01 09:00:00"), (None, "1", "2026-01-01 09:00:00")]
SECOND = [("C1", "90", "2025-12-01 09:00:00"), ("C2", "250", "2026-01-03 09:00:00"), ("C4", "400", "2026-01-03 09:00:00")]


def test_runs_end_to_end(spark, db):
    done, gone = [], []
    f = feed(spark, db, [claims(spark, *FIRST), claims(spark, *SECOND), claims(spark, *SECOND)], commit=done.append, discard=gone.append)
    r1, checks = pipeline.run_feed(spark, f, "r1")
    assert all(c.passed for c in checks) and len(checks) == 3 and content(spark, f.curated_table, "claim_id", "amount") == [("C1", "100"), ("C2", "200")]
    pipeline.run_feed(spark, f, "r2")
    want = [("C1", "100", "I"), ("C2", "250", "U"), ("C4", "400", "I")]
    assert content(spark, f.curated_table, "claim_id", "amount", "last_modified_op") == want and done == ["r1", "r2"]
    assert spark.table(f.raw_table).count() == 7 and content(spark, f.rejects_table, "error_code", "raw_record") == [("R1", '{"claim_id":"C3","amount":"x","modified_ts":"2026-01-01 09:00:00"}')]
    control = {r.batch_id: r for r in ledger.batch_control(spark.table(f.ledger_table)).collect()}
    assert control["r1"].curated_done and control["r1"].rejected_count == 1 and control["r2"].update_count == 1 and control["r2"].insert_count == 1
    pipeline.replay(spark, f, "r1")
    assert content(spark, f.curated_table, "claim_id", "amount", "last_modified_op") == want and done == ["r1", "r2"]
    with pytest.raises(pipeline.PipelineError, match="PIPE_005"):
        pipeline.replay(spark, f, "nope")


def test_a_failed_run_commits_nothing_and_is_picked_up(spark, db):
    done, gone = [], []
    f = feed(spark, db, [claims(spark, *FIRST), claims(spark, *SECOND)], commit=done.append, discard=gone.append)
    pipeline.run_feed(spark, f, "r1")
    good = f.types
    f.types = {"amount": "date"}
    with pytest.raises(pipeline.PipelineError, match="CUR_003"):
        pipeline.run_feed(spark, f, "r2")
    f.types = good
    assert done == ["r1"] and gone == ["r2"] and [r.run_id for r in ledger.failed_pending(spark.table(f.ledger_table)).collect()] == ["r2"]
    assert pipeline.drive_batches(spark, f, "pending") == [("r2", "SUCCESS")] and pipeline.drive_batches(spark, f, "pending") == []
    assert content(spark, f.curated_table, "claim_id", "amount") == [("C1", "100"), ("C2", "250"), ("C4", "400")]
    with pytest.raises(pipeline.PipelineError, match="PIPE_007"):
        pipeline.drive_batches(spark, f, "some")


def test_the_same_run_does_not_land_twice(spark, db):
    f = feed(spark, db, [claims(spark, *SECOND)] * 3, idempotency_key=("claim_id", "modified_ts"), reject_rules=[])
    pipeline.run_feed(spark, f, "r1")
    pipeline.run_feed(spark, f, "r1", resume=True)
    run_id, checks = pipeline.run_feed(spark, f, "r2")
    assert spark.table(f.raw_table).count() == 3 and [c.actual for c in checks if c.name == "raw_overlap_reread"] == []
    assert spark.table(f.ledger_table).filter("status = 'SKIPPED'").count() == 2 and spark.table(f.curated_table).count() == 3


WINDOW = ("2026-01-01T00:00:00Z", "2026-01-05T00:00:00Z")


@pytest.mark.parametrize("policy", ["FAIL", "WARN"])
def test_a_window_that_landed_but_was_not_curated_is_curated_by_the_next_run(spark, db, policy):
    """r1 lands and dies in the curated stage; r2 over the same window lands nothing, curates what r1 landed, and only then commits."""
    done = []
    f = feed(spark, db, [claims(spark, *SECOND)] * 3, commit=done.append, window=lambda run_id: WINDOW, on_mismatch=policy, reject_rules=[])
    f.types = {"amount": "date"}
    with pytest.raises(pipeline.PipelineError, match="CUR_003"):
        pipeline.run_feed(spark, f, "r1")
    f.types = {}
    assert done == [] and spark.table(f.raw_table).count() == 3
    run_id, checks = pipeline.run_feed(spark, f, "r2")
    assert all(c.passed for c in checks) and {c.name for c in checks} >= {"raw_equals_accepted", "curated_accounts_for_accepted_rows", "watermark_continuity"}
    assert done == ["r2"] and spark.table(f.raw_table).count() == 3
    assert content(spark, f.curated_table, "claim_id", "amount") == [("C1", "90"), ("C2", "250"), ("C4", "400")]
    pipeline.run_feed(spark, f, "r3")
    pipeline.replay(spark, f, "r2")
    assert done == ["r2", "r3"] and spark.table(f.curated_table).count() == 3 and spark.table(f.raw_table).count() == 3


def test_a_resumed_run_curates_the_window_it_skipped(spark, db):
    f = feed(spark, db, [claims(spark, *SECOND)] * 2, window=lambda run_id: WINDOW, reject_rules=[])
    f.types = {"amount": "date"}
    for run_id in ("r1", "r2"):
        with pytest.raises(pipeline.PipelineError, match="CUR_003"):
            pipeline.run_feed(spark, f, run_id)
    f.types = {}
    pipeline.run_feed(spark, f, "r2", resume=True)
    assert spark.table(f.curated_table).count() == 3 and spark.table(f.raw_table).count() == 3


def test_windows_that_drift_or_leave_a_gap_are_told(spark, db):
    windows = {"r1": WINDOW, "r2": (WINDOW[0], "2026-01-06T00:00:00Z"), "r3": ("2026-01-09T00:00:00Z", "2026-01-10T00:00:00Z")}
    f = feed(spark, db, [claims(spark, *SECOND)] * 3, window=windows.get, reject_rules=[], control_total="sum(amount)")
    pipeline.run_feed(spark, f, "r1")
    pipeline.run_feed(spark, f, "r2")
    ended = {r.run_id: (r.message, r.control_total) for r in spark.table(f.ledger_table).filter("stage = 'raw' AND status = 'SUCCESS'").collect()}
    assert ended["r1"] == ("", "740.0") and ended["r2"][0].startswith("drift: ")
    with pytest.raises(ledger.ReconciliationError, match="watermark_continuity"):
        pipeline.run_feed(spark, f, "r3")


def test_rejects_of_a_run_are_one_slice_and_ends_are_told(spark, db):
    ends = []
    f = feed(spark, db, [claims(spark, *FIRST)] * 3 + [claims(spark, *SECOND)], reject_payload="HASHED", on_finish=ends.append, on_mismatch="WARN")
    pipeline.run_feed(spark, f, "r1")
    pipeline.run_feed(spark, f, "r1", force=True)
    (secret,) = content(spark, f.rejects_table, "raw_record")
    assert "C3" not in secret[0] and secret[0].count(":") == 3
    f.reject_rules = [RejectRule("none", "claim_id = 'C1'", "R2", "x")]
    pipeline.run_feed(spark, f, "r1", force=True)
    assert content(spark, f.rejects_table, "error_code") == [("R2",)]

    def fails(body):
        raise OSError("nobody listens")

    f.on_finish = lambda body: ends.append(body) or fails(body)
    f.types = {"amount": "date"}
    with pytest.raises(pipeline.PipelineError, match="CUR_003"):
        pipeline.run_feed(spark, f, "r4")
    assert [(e["run_id"], e["status"]) for e in ends] == [("r1", "SUCCESS")] * 3 + [("r4", "FAILED")]


def test_files_that_have_landed_are_left_out(spark, db):
    def read(n):
        return spark.createDataFrame([(f"C{i}", str(i), "2026-01-01 09:00:00", f"f{i // 2}") for i in range(n)], "claim_id string, amount string, modified_ts string, source_file string")

    f = feed(spark, db, [read(4), read(7)], skip_loaded_files=True, reject_rules=[])
    pipeline.run_feed(spark, f, "r1")
    pipeline.run_feed(spark, f, "r2")
    assert spark.table(f.raw_table).count() == 7 and spark.table(f.curated_table).count() == 7


def test_too_many_emptied_partitions_are_refused_before_anything_changes(spark, db, monkeypatch):
    spec = MergeSpec(keys=("claim_id",), freshness="modified_ts", partition_columns=("amount",))
    f = feed(spark, db, [claims(spark, ("C1", "1", "2026-01-01"), ("C2", "2", "2026-01-01")), claims(spark, ("C1", "3", "2026-01-02"), ("C2", "3", "2026-01-02"))], spec=spec, publish_mode="PARTITION_OVERWRITE")
    pipeline.run_feed(spark, f, "r1")
    before = content(spark, f.curated_table, "claim_id", "amount")
    monkeypatch.setattr(publish.droppable, "__defaults__", (1,))
    with pytest.raises(PublishError, match="more than 1 partitions"):
        pipeline.run_feed(spark, f, "r2")
    assert content(spark, f.curated_table, "claim_id", "amount") == before


def test_rejects_hold_the_position(spark, db):
    done = []
    f = feed(spark, db, [claims(spark, *FIRST)], commit=done.append, hold_on_rejects=True)
    pipeline.run_feed(spark, f, "r1")
    assert done == []
    with pytest.raises(Exception, match="percent"):
        pipeline.run_feed(spark, feed(spark, db, [claims(spark, *FIRST)], max_reject_percent=5), "r9")


def test_partitioned_feed_drops_emptied_partitions(spark, db):
    spec = MergeSpec(keys=("claim_id",), freshness="modified_ts", partition_columns=("amount",))
    f = feed(spark, db, [claims(spark, ("C1", "1", "2026-01-01"), ("C2", "2", "2026-01-01")), claims(spark, ("C1", "3", "2026-01-02"))], spec=spec, publish_mode="PARTITION_OVERWRITE")
    pipeline.run_feed(spark, f, "r1")
    pipeline.run_feed(spark, f, "r2")
    assert content(spark, f.curated_table, "claim_id", "amount") == [("C1", "3"), ("C2", "2")]
    assert sorted(r.partition for r in spark.sql(f"SHOW PARTITIONS {f.curated_table}").collect()) == ["amount=2", "amount=3"]


def test_contract_and_dry_run(spark, db):
    c = Contract((ContractColumn("claim_id", nullable=False, sensitive=True), ContractColumn("amount"), ContractColumn("modified_ts")))
    f = feed(spark, db, [claims(spark, *FIRST), claims(spark, *SECOND)], contract=c)
    with pytest.raises(Exception, match="nullability"):
        pipeline.run_feed(spark, f, "r1")
    pipeline.run_feed(spark, f, "r2", dry_run=True)
    assert not spark.catalog.tableExists(f.raw_table) and ledger.batches(spark.table(f.ledger_table)).count() == 0


def test_keyless_full_publish_and_empty_batch(spark, db):
    f = feed(spark, db, [claims(spark, *FIRST), claims(spark)], spec=None, reject_rules=[])
    pipeline.run_feed(spark, f, "r1", mode="FULL")
    assert spark.table(f.curated_table).count() == 5
    g = feed(spark, db, [claims(spark)], curated_table=f"{db}.other", raw_table=f"{db}.raw2", reject_rules=[])
    pipeline.run_feed(spark, g, "r2")
    assert spark.table(g.curated_table).count() == 0


def test_micro_batches_converge(spark, db, tmp_path):
    source, told = tmp_path / "in", []
    source.mkdir()
    sink = microbatch.MicroBatchMerge(f"{db}.s", MergeSpec(keys=("k",), freshness="v"), on_counts=lambda run, n: told.append((run, n)))
    go = lambda: microbatch.start(spark.readStream.schema("k string, v int, x string").json(str(source)), sink, str(tmp_path / "cp"), available_now=True).awaitTermination()
    (source / "1.json").write_text('{"k":"a","v":2,"x":"new"}\n{"k":"b","v":1,"x":"b"}\n{"k":null,"v":1}\n')
    go()
    (source / "2.json").write_text('{"k":"a","v":1,"x":"late"}\n{"k":"b","v":3,"x":"b3"}\n{"k":"c","v":1,"x":"c"}\n')
    go()
    want = [("a", 2, "new"), ("b", 3, "b3"), ("c", 1, "c")]
    assert content(spark, f"{db}.s", "k", "v", "x") == want and told == [("stream-1", {"inserted": 1, "updated": 1, "deleted": 0, "ignored": 1})]
    sink(spark.read.schema("k string, v int, x string").json(str(source / "2.json")), 1)
    sink(spark.createDataFrame([], "k string, v int, x string"), 2)
    assert content(spark, f"{db}.s", "k", "v", "x") == want
    with pytest.raises(merge.MergeError, match="CUR_007"):
        microbatch.MicroBatchMerge("t", SPEC, publish_mode="FULL_OVERWRITE")
    with pytest.raises(ValueError, match="KAF_002"):
        microbatch.start(None, sink, "")


def test_one_of_many_claimants_wins():
    for _ in range(5):
        events, won, guard = [], [], threading.Lock()

        def claim(i, events=events, won=won, guard=guard):
            def append(e):
                with guard:
                    events.append(e)

            lock = locks.LeaseLock("e", f"r{i}", lambda: list(events), append, settle_ms=60)
            try:
                lock.acquire()
                won.append(i)
            except locks.LockError:
                pass

        threads = [threading.Thread(target=claim, args=(i,)) for i in range(8)]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert len(won) == 1


def test_leases_expire_and_are_taken_over():
    now, events = [1000.0], []
    make = lambda r: locks.LeaseLock("e", r, lambda: list(events), events.append, minutes=10, settle_ms=0, clock=lambda: now[0], sleep=lambda s: None)
    a, b = make("a"), make("b")
    a.acquire()
    with pytest.raises(locks.LockError, match="held by a"):
        b.acquire()
    now[0] += 300
    assert a.renew()
    now[0] += 601
    b.acquire()
    assert not a.renew()
    with pytest.raises(locks.LockError, match="PIPE_001"):
        a.check()
    b.check()
    b.release()
    make("c").acquire()


@pytest.mark.parametrize(
    ("code", "conf"),
    [
        ("CFG_001", {"source": {"type": "file", "extraction": {"strategy": "X", "boundary": 1}}}), ("CFG_002", {"source": {"type": "jdbc", "extraction": {"strategy": "INCREMENTAL"}}}), ("CFG_003", {"source": {"type": "jdbc", "extraction": {"strategy": "FULL_SNAPSHOT", "boundary": {"overlap": 1}}}}),
        ("CFG_004", {"raw": {"strategy": "CDC_EVENTS"}, "curated": {"x": 1}}), ("CFG_005", {"curated": {"strategy": "TYPE1_MERGE"}}), ("CFG_006", {"rejects": {"use_contract_nullability": True}}), ("CFG_007", {"audit": {"enabled": False, "reconciliation": {"on_mismatch": "FAIL"}}}),
        ("CFG_008", {"source": {"incremental": {"x": 1}}}), ("CFG_009", {"source": {"type": "jdbc", "mode": "INCREMENTAL"}, "curated": {"x": 1}}), ("CFG_010", {"ingestion": {"pattern": "CDC"}}), ("CFG_011", {"ingestion": {"pattern": "TIMESTAMP_OVERLAP"}}),
        ("CFG_012", {"ingestion": {"pattern": "BACKFILL"}, "watermark": {"advance_after": "RAW"}}), ("CFG_013", {"raw": {"delivery_mode": "DEDUPLICATED_APPEND"}}), ("CFG_013", {"raw": {"idempotency_key": ["RUN_ID"]}}), ("CFG_014", {"curated": {"merge": {"deletes": {"mode": "FULL_SNAPSHOT_ABSENCE"}}}}),
        ("CFG_015", {"curated": {"pending": {"on_failure": "X"}}}), ("CFG_016", {"ingestion": {"execution": "DECOUPLED"}, "source": {"type": "jdbc", "incremental": {"x": 1}}}), ("CFG_017", {"curated": {"merge": {"freshness": {"tie_breakers": ["a up"]}}}}),
    ],
)
def test_contradictions_in_configuration(code, conf):
    assert any(p.startswith(code) for p in config.problems(conf))
    with pytest.raises(config.ConfigError, match=code):
        config.check(conf, "raw")


def test_configuration_layers_and_classes():
    assert config.problems({}) == [] and config.pattern({"source": {"type": "jdbc", "mode": "INCREMENTAL", "incremental": {"overlap": 5}}}) == "TIMESTAMP_OVERLAP"
    merged, paths, digest = config.override({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": 4})
    assert merged == {"a": {"b": 3, "c": 2}, "d": 4} and paths == ["a.b"] and len(digest) == 64
    assert config.fingerprint({"a": {"b": 1}}) == config.fingerprint({"a": {"b": 2}}) != config.fingerprint({"a": {"c": 1}})
    for e, kind in ((locks.LockError("x"), config.TRANSIENT), (PublishError("x"), config.DATA), (ValueError("HDR_001 x"), config.DATA), (ValueError("CFG_001"), config.CONFIGURATION), (ConnectionResetError(), config.TRANSIENT), (RuntimeError("x: java.net.SocketException: y"), config.TRANSIENT), (RuntimeError("error, SQLState: 08006"), config.TRANSIENT), (RuntimeError("[X] SQLSTATE: 22018"), config.DATA), (RuntimeError("SQL state [42601]"), config.CONFIGURATION), (ValueError("?"), config.UNCLASSIFIED)):
        assert config.classify(e) is kind
    with pytest.raises(config.ConfigError, match="separately"):
        config.check({"ingestion": {"execution": "DECOUPLED"}})


def test_arguments():
    a = pipeline.parse_arguments(["--feed", "m:f", "--stage", "curated", "--between", "2026-01-01", "2026-01-02"])
    assert a.between == ["2026-01-01", "2026-01-02"]
    for bad in (["--feed", "m:f", "--pending"], ["--feed", "m:f", "--stage", "curated"], ["--feed", "m:f", "--stage", "curated", "--pending", "--failed"], []):
        with pytest.raises(SystemExit):
            pipeline.parse_arguments(bad)
    assert not pipeline.notify({}, webhook="http://127.0.0.1:9/none", timeout=0.2) and pipeline.notify({"a": 1}, command=["cat"])


def test_command_line(spark, db, tmp_path, monkeypatch, capsys):
    """Every stage and selection from the command line, one after the other."""
    import sys
    import types

    f = feed(spark, db, [], reject_rules=[], contract=Contract((ContractColumn("claim_id"), ContractColumn("amount", aliases=("amt",)), ContractColumn("modified_ts"))))
    coming = [claims(spark, *SECOND[:1]), claims(spark, *SECOND[1:])]
    f.read = lambda run_id: coming.pop(0).withColumn("source_file", F.lit(f"file-{len(coming)}"))
    monkeypatch.setitem(sys.modules, "feeds_of_test", types.SimpleNamespace(claims=lambda spark: f))
    run = lambda *argv: pipeline.main(["--feed", "feeds_of_test:claims", *argv])
    (tmp_path / "c.json").write_text('{"source": {"type": "jdbc"}, "curated": {"strategy": "TYPE1_MERGE"}}')
    (tmp_path / "o.json").write_text('{"curated": {"merge": {"keys": ["claim_id"]}}}')
    assert run("--validate-only") == 0 and run("--validate-only", "--conf-path", str(tmp_path / "c.json")) == 30
    assert run("--validate-only", "--conf-path", str(tmp_path / "c.json"), "--override-path", str(tmp_path / "o.json")) == 0
    assert run("--stage", "raw", "--run-id", "r1") == 0 and run("--stage", "raw", "--run-id", "r2", "--raw-flag", "X") == 0
    landed = {r.run_id: (r.file_type, r.file_id) for r in spark.table(f.raw_table).select("run_id", "file_type", "file_id").distinct().collect()}
    assert (landed["r1"][0], landed["r2"][0]) == ("I", "X") and not spark.catalog.tableExists(f.curated_table)
    assert run("--stage", "curated", "--replay-source-system", "nobody") == 0 and not spark.catalog.tableExists(f.curated_table)
    assert run("--stage", "curated", "--run-id", "r2", "--file-id", landed["r2"][1]) == 0 and content(spark, f.curated_table, "claim_id") == [("C2",), ("C4",)]
    assert run("--stage", "curated", "--pending") == 0 and content(spark, f.curated_table, "claim_id") == [("C1",), ("C2",), ("C4",)]
    assert run("--stage", "curated", "--run-id", "nope") == 1
    spark.table(f.raw_table).withColumn("ingest_dt", F.lit("2026-01-05")).write.saveAsTable(f"{db}.days")
    f.raw_table = f"{db}.days"
    assert run("--stage", "curated", "--resume-ingest-dt", "2026-01-05", "--raw-flag", "X") == 0
    capsys.readouterr()
    f.read = lambda run_id: claims(spark, *SECOND).withColumnRenamed("amount", "AMT")
    assert run("--explain-mapping") == 0 and capsys.readouterr().out.splitlines()[:2] == ["claim_id\tclaim_id\tEXACT", "AMT\tamount\tALIAS"]


def test_batches_of_a_source_system(spark, db):
    f = feed(spark, db, [claims(spark, *SECOND[:1]), claims(spark, *SECOND[1:])], reject_rules=[])
    for run_id, system in (("r1", "east"), ("r2", "west")):
        pipeline.land(pipeline.Run(spark, f, run_id))
    marked = spark.table(f.raw_table).withColumn("source_system", F.when(F.col("run_id") == "r1", "east").otherwise("west"))
    marked.write.saveAsTable(f"{db}.marked")
    f.raw_table = f"{db}.marked"
    assert pipeline.drive_batches(spark, f, "pending", source_system="west") == [("r2", "SUCCESS")]
    assert pipeline.drive_batches(spark, f, "pending") == [("r1", "SUCCESS")]


def test_database_lease(spark, tmp_path):
    now, url = [1000.0], f"jdbc:derby:{tmp_path / 'locks'};create=true"
    make = lambda r: locks.DatabaseLease(spark, url, "e", r, minutes=1, clock=lambda: now[0], driver="org.apache.derby.jdbc.EmbeddedDriver")
    a, b = make("a"), make("b")
    a.create_table()
    a.acquire()
    a.acquire()
    with pytest.raises(locks.LockError, match="held by a"):
        b.acquire()
    now[0] += 61
    stale = a._row()[2]
    b.acquire()
    assert not a.renew() and not a._set("a", 9e9, stale) and b.renew()
    b.release()
    make("c").acquire()


def test_publish_modes_and_purge(spark, db):
    assert merge.resolve_publish_mode(None, True, True, (), ()) == "MERGE" and merge.resolve_publish_mode(None, False, True, (), ()) == "FULL_OVERWRITE" and merge.resolve_publish_mode("partition_overwrite", True, False, ("p",), ("k",)) == "FULL_OVERWRITE"
    for bad in (("PARTITION_OVERWRITE", True, True, (), ("k",)), ("PARTITION_OVERWRITE", True, True, ("p",), ("k",), "FULL_SNAPSHOT_ABSENCE"), ("OTHER", True, True, (), ())):
        with pytest.raises(merge.MergeError):
            merge.resolve_publish_mode(*bad)
    spark.range(10).write.saveAsTable(f"{db}.t")
    assert publish.purge(spark, f"{db}.t", spark.table(f"{db}.t").filter("id > 3"), dry_run=True) == 4 and spark.table(f"{db}.t").count() == 10
    assert publish.purge(spark, f"{db}.t", spark.table(f"{db}.t").filter("id > 3")) == 4 and spark.table(f"{db}.t").count() == 6
