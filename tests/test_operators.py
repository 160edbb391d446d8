import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.functions.hashing import record_hash
from sluice.functions.instants import instant_text_micros, micros_of
from sluice.operators import ledger, rejects, retention, stamps, validate
from sluice.operators.contract import Contract, ContractColumn, ContractError, apply_contract, curated_gate, enforce, explain, fingerprint, recorded_properties, resolve_header, type_changes, version_violations
from sluice.operators.validate import ContentRule
from sluice.session import lookup_join

T0 = dt.datetime(2026, 1, 1)


def test_record_hash_ignores_column_order_and_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "B string, a string")
    got = [r[0] for r in df.select(record_hash(["B", "a"])).collect()]
    assert got == [hashlib.sha256(x.encode()).hexdigest() for x in ("\0\1a", "\1a", "a\1\0")]
    assert df.select(record_hash(["a", "B"])).collect() == df.select(record_hash(["B", "a"])).collect()
    assert df.select(record_hash([])).first()[0] == ""


def test_stamps(spark):
    df = spark.createDataFrame([(1, "x", "y")], "id int, v string, flag string")
    out = stamps.stamp_extended(stamps.stamp_raw(df, "csv", stamps.Lineage("r"), F.lit("f")), ["id"], delete_indicator="flag").first()
    assert out.source_operation == "D" and out.source_primary_key_json == '{"id":1}' and out.run_id == "r" and out.extract_end_ts == ""
    with pytest.raises(stamps.StampError, match="RAW_003"):
        stamps.stamp_raw(df.withColumn("Row_Idx", F.lit(1)), "csv")
    assert set(stamps.content_columns(stamps.stamp_raw(df, "csv"))) == {"id", "v", "flag"}
    audited = stamps.stamp_audit(df.withColumn("create_timestamp", F.lit("kept")), run_id="r").first()
    assert audited.create_timestamp == "kept" and audited.last_modified_op == "I" and "last_modified_run_id" not in audited.asDict()
    kafka = df.withColumn("kafka_offset", F.lit(1))
    assert stamps.drop_technical(kafka).columns == df.columns and stamps.drop_technical(kafka, retain=True).columns == kafka.columns
    with pytest.raises(stamps.StampError, match="CUR_007"):
        stamps.drop_technical(kafka, needed=["kafka_offset"])


def test_transforms_see_the_values_before(spark):
    df = spark.createDataFrame([(" a ", "b")], "x string, y string")
    assert tuple(stamps.contract_transforms(df, {"x": "TRIM", "y": "concat({col}, x)"}).first()) == ("a", "b a ")


def test_content_rules(spark):
    df = spark.createDataFrame([("5",), ("x",), (None,), ("",), (" 7 ",)], "c string")
    one = lambda **k: validate.content_failures(df, {"C": ContentRule(**k)}).first().n_failed
    assert (one(numeric=True), one(regex=r"^\d$"), one(nonblank=True), one(min_length=1), one(max_length=0), one(allowed_values=("5",)), one(max_null_percentage=1)) == (3, 3, 2, 2, 4, 4, 0)
    dates = spark.createDataFrame([("2026-01-31",), ("31.01.2026",), ("2026-02-30",)], "d string")
    assert validate.content_failures(dates, {"d": ContentRule(date_formats=("yyyy-MM-dd", "dd.MM.yyyy"))}).first().n_failed == 1
    assert len(validate.content_violations(df, {"c": ContentRule(numeric=True, max_failure_percentage=10, max_null_percentage=10)})) == 2
    assert validate.content_violations(df.limit(0), {"c": ContentRule(numeric=True)}) == [] and validate.content_failures(df, {"zz": ContentRule()}).count() == 0
    assert validate.all_null_columns(df.withColumn("n", F.lit(None)), ["c", "n"]) == ["n"]
    assert validate.sample_rows(spark.range(1000), 50).count() <= 50 and validate.sample_rows(spark.range(10), 50).count() == 10
    assert validate.partition_skew(spark.range(0, 100, 1, 4)).first().ratio == 1.0


def test_rejects(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "n int, s string")
    good, bad = rejects.split(df, [rejects.RejectRule("small", "n < 2", "R1", "m"), rejects.required_rule("s")])
    assert [r.s for r in good.collect()] == ["b"] and sorted(r.error_code for r in bad.collect()) == ["NOT_NULL", "R1"] and good.columns == df.columns
    rejects.check_limits(100, 5, max_percent=5)
    for k in (dict(max_count=4), dict(max_percent=4)):
        with pytest.raises(rejects.RejectLimitError):
            rejects.check_limits(100, 5, **k)
    with pytest.raises(ValueError, match="payload mode"):
        rejects.payload(["n"], "NONE")
    old = spark.createDataFrame([("e", "r1", 1), ("e", "r2", 2)], "entity string, run_id string, reject_ts int")
    assert rejects.replaced_slice(old, old.filter("run_id = 'r1'"), {"run_id": "r1"}) is None
    got = rejects.replaced_slice(old, old.filter("run_id = 'r1'").withColumn("entity", F.lit("f")), {"run_id": "r1"})
    assert sorted((r.entity, r.run_id) for r in got.collect()) == [("e", "r2"), ("f", "r1")]


def events(spark, rows):
    cols = "run_id string, entity string, stage string, status string, message string, event_ts timestamp_ntz, run_mode string, window_start string, window_end string, rejected_count bigint"
    return spark.createDataFrame([(r, "e", s, st, m, T0 + dt.timedelta(minutes=i), "INCR", w, w and w + "z", n) for i, (r, s, st, m, w, n) in enumerate(rows)], cols)


def test_ledger_scenarios(spark):
    runs = events(
        spark,
        [
            ("r1", "raw", "SUCCESS", None, "a", 0), ("r1", "curated", "SUCCESS", "", "a", 0), ("r1", "curated", "FAILED", "later", "a", 0), ("r2", "raw", "SUCCESS", "", "az", 3), ("r2", "curated", "FAILED", "x", "az", 0),
            ("r3", "raw", "SUCCESS", "", "q", 0), ("r3", "raw", "SKIPPED", "", "q", 0), ("r4", "raw", "SUCCESS", "dry-run", "", 0), ("r5", "raw", "FAILED", "", "", 0), ("r6", "raw", "STARTED", "", "", 0),
        ],
    )
    ids = lambda df: sorted(r.run_id for r in df.collect())
    assert ids(ledger.pending(runs)) == ["r2", "r3"] and ids(ledger.failed_pending(runs)) == ["r2"] and ids(ledger.batches(runs)) == ["r1", "r2", "r3"]
    assert [r.run_id for r in ledger.last_batches(runs, "e", 2).collect()] == ["r3", "r2"] and ids(ledger.batches_between(runs, "e", "2026-01-01", "2026-01-01")) == ["r1", "r2", "r3"]
    assert ledger.window_had_rejects(runs, "e", "new", "az", "azz") and not ledger.window_had_rejects(runs, "e", "r2", "az", "azz")
    got = {r.run_id: r.continuous for r in ledger.window_continuity(runs).collect()}
    assert got == {"r1": True, "r2": True, "r3": False, "r4": got.get("r4")} or got == {"r1": True, "r2": True, "r3": False}
    assert ids(ledger.pending(runs.limit(0))) == []
    assert ledger.sanitize("x Password=abc;y") == "x Password=***;y" and ledger.sanitize(None) == "" and ledger.sanitize("a" * 5000).endswith(" [1000 characters cut]")
    assert ledger.sanitize("jdbc:x://ann:pw@h/d?user=ann&db.password='a b'&n=1") == "jdbc:x://***@h/d?user=ann&db.password=***&n=1"
    assert ledger.sanitize('{"apiKey": "k", "rows": 5} Authorization: Bearer abcdefgh12 end') == '{"apiKey": ***, "rows": 5} Authorization: *** *** end'


def test_reconciliation():
    c = ledger.Counts(source=10, raw=7, accepted=8, rejected=2, overlap_skipped=1, duplicate_versions=0, inserted=3, updated=1, deleted=1, ignored=1, blank_key=1, deduped=1)
    checks = ledger.reconcile(c, ("a", "b"), ("0", "a"))
    assert len(checks) == 6 and all(k.passed for k in checks)
    bad = ledger.reconcile(ledger.Counts(source=10, accepted=8, rejected=1), ("c", "d"), ("0", "a"))
    assert [k.name for k in bad if not k.passed] == ["source_equals_accepted_plus_rejected", "watermark_continuity"]
    with pytest.raises(ledger.ReconciliationError):
        ledger.enforce(bad)
    assert len(ledger.enforce(bad, "WARN")) == 2 and ledger.reconcile(ledger.Counts()) == []


def test_retention(spark):
    df = spark.createDataFrame([(1, T0), (2, None), (3, T0 - dt.timedelta(days=9))], "i int, t timestamp_ntz")
    assert sorted(r.i for r in retention.survivors_since(df, "t", F.lit("2026-01-01").cast("timestamp_ntz")).collect()) == [1, 2]
    parts = spark.createDataFrame([("2025-12-31",), ("2026-01-01",), ("odd",), (None,)], "d string")
    assert [r.d for r in retention.expired_partitions(parts, "d", "2026-01-01").collect()] == ["2025-12-31"]
    assert retention.parse_days("400d") == 400
    for bad in ("400", "d", "-1d"):
        with pytest.raises(ValueError, match="PIPE_004"):
            retention.parse_days(bad)


def contract(strategy="NAME_ALIAS", **k):
    return Contract((ContractColumn("subscriber_id", aliases=("sub no",), position=0, nullable=False, business_key=True), ContractColumn("amount", "int", position=1), ContractColumn("note", position=2, required=False, default="none")), strategy, **k)


def kinds(violations):
    return [v.code for v in violations]


def test_header_resolution():
    r = resolve_header(contract(), ["Sub No", "AMOUNT", "extra"])
    assert r.renames == {"Sub No": "subscriber_id", "AMOUNT": "amount"} and kinds(r.violations) == ["HDR_006"]
    assert explain(contract(), r) == [("Sub No", "subscriber_id", "ALIAS"), ("AMOUNT", "amount", "EXACT"), ("extra", "", "UNEXPECTED")]
    assert kinds(resolve_header(contract(), ["amount", "amount", "A-mount", "subscriber id", "sub.no", " "]).violations) == ["HDR_002", "HDR_010", "HDR_005", "HDR_006", "order_change"]
    assert kinds(resolve_header(contract("STRICT_NAME"), ["sub no", "amount"]).violations) == ["HDR_001", "HDR_006"]
    assert resolve_header(contract("POSITION"), ["a", "b", "c"]).renames == {"a": "subscriber_id", "b": "amount", "c": "note"} and kinds(resolve_header(contract("POSITION"), ["a"]).violations) == ["HDR_007"]
    back = resolve_header(contract("NAME_ALIAS_POSITION_FALLBACK"), ["a", "b", "c"])
    assert back.by_position and not resolve_header(contract("NAME_ALIAS_POSITION_FALLBACK"), ["amount", "sub no", "note"]).by_position
    assert kinds(resolve_header(contract(), ["amount", "sub no"]).violations) == ["order_change"]
    assert fingerprint(resolve_header(contract(), ["Sub No", "amount"])) == fingerprint(resolve_header(contract(), ["subscriber_id", "AMOUNT"]))
    with pytest.raises(ContractError, match="HDR_001.*HDR_001"):
        enforce(resolve_header(contract(), ["x"]).violations)
    assert enforce(resolve_header(contract(policies={"missing_required": "WARN", "unexpected_column": "IGNORE"}), ["x"]).violations)[0].code == "HDR_001"


def test_alias_periods():
    c = Contract((ContractColumn("a", aliases=("b",), alias_windows={"b": ("2026-01-01", "2026-06-30")}),))
    assert resolve_header(c, ["b"], "2026-03-01").renames and not resolve_header(c, ["b"], "2026-07-01").renames


def test_contracts_that_contradict_themselves():
    for bad in (lambda: Contract((ContractColumn("a", aliases=("B",)), ContractColumn("b"))), lambda: Contract((ContractColumn("a", "nothing"),)), lambda: Contract((ContractColumn("--"),)), lambda: Contract((ContractColumn("a", position=1),), "POSITION"), lambda: Contract((), "GUESS")):
        with pytest.raises(ContractError):
            bad()


def test_contract_on_frames(spark):
    df = spark.createDataFrame([("s", "1")], "`Sub No` string, `a.mount` string")
    c = Contract((ContractColumn("subscriber_id", aliases=("sub no",)), ContractColumn("a_mount", "int"), ContractColumn("note", required=False, default="none")))
    out = apply_contract(df, c, resolve_header(c, df.columns))
    assert out.columns == ["subscriber_id", "a_mount", "note"] and out.first().note == "none" and type_changes(c, out) == []
    assert kinds(type_changes(c, out.withColumn("a_mount", F.lit(1.5)))) == ["type_change"]
    assert kinds(curated_gate(out.drop("a_mount"), c, ["subscriber_id"], ["when"])) == ["HDR_018"] * 2
    assert kinds(curated_gate(out.withColumn("a_mount", F.lit(None)), c, ["subscriber_id"], [])) == ["HDR_018"]
    wide = spark.range(1).select(*[F.lit(i).alias(f"Src Col {i}") for i in range(364)])
    w = Contract(tuple(ContractColumn(f"src_col_{i}", "int") for i in range(364)))
    plan = apply_contract(wide, w, resolve_header(w, wide.columns))._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") <= 3
    assert version_violations(c, recorded_properties(c)) == [] and kinds(version_violations(c, {"ingest.schema.version": "0", "ingest.schema.required": "a_mount"})) == ["HDR_014", "HDR_014"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instants_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2026-05-17 22:20:06.334959", "2026-05-17T22:20:06.334959Z", "2026-05-18T00:20:06.334959+02:00", "2026-05-17 17:20:06.334959-05:00", "1779056406334959", " 2026-05-17 22:20:06.334959 "]
        df = spark.createDataFrame([(t,) for t in [*texts, "", None, "soon", "2026-03-08 02:30:00"]], "t string").select(instant_text_micros(F.col("t")).alias("m"))
        got = [r.m for r in df.collect()]
        assert got[:6] == [1779056406334959] * 6 and got[6:9] == [None] * 3 and got[9] == 1772937000000000
        ntz = spark.createDataFrame([(dt.datetime(2026, 3, 8, 2, 30, 0, 5),), (dt.datetime(1969, 12, 31, 23, 59, 59),)], "t timestamp_ntz")
        assert [r[0] for r in ntz.select(micros_of(F.col("t"), ntz.schema["t"].dataType)).collect()] == [1772937000000005, -1_000_000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("row_bytes", [8, 1 << 30])
def test_lookup_join_is_the_same_broadcast_or_salted(spark, row_bytes):
    big = spark.createDataFrame([(i, "hot" if i % 3 else None, i % 2) for i in range(300)], "i int, a string, b int")
    small = spark.createDataFrame([("hot", 1, "x"), (None, 0, "y")], "a string, b int, z string")
    got = lookup_join(big, small, ["a", "b"], "left", row_bytes)
    assert got.columns == ["i", "a", "b", "z"] and got.count() == 300
    assert {(r.a, r.b, r.z) for r in got.collect()} == {("hot", 1, "x"), ("hot", 0, None), (None, 0, "y"), (None, 1, None)}
