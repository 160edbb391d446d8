import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import watermark as wm
from sluice.operators.contract import Contract, ContractColumn, ContractError
from sluice.sources import files, intake, jdbc, kafka, raw, sqltext
from sluice.sources.sqltext import Filter, Projection, SqlError

CONTRACT = Contract((ContractColumn("subscriber_id", aliases=("subscriber id",), position=0), ContractColumn("hios_id", aliases=("plan_hios_id",), position=1), ContractColumn("note", required=False, default="none", position=2)))


def write(folder, **content):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in content.items():
        (folder / f"{name}.csv").write_text(text)


def test_layouts_are_read_together(spark, tmp_path):
    write(tmp_path, a="Subscriber Id,plan_hios_id,note\nS1,H1,x\n", b="hios_id,subscriber_id\nH2,S2\n")
    got = files.read_grouped(spark, {str(tmp_path / "a.csv"): ["Subscriber Id", "plan_hios_id", "note"], str(tmp_path / "b.csv"): ["hios_id", "subscriber_id"]}, CONTRACT)
    assert sorted((r.subscriber_id, r.hios_id, r.note, r.source_file[-5:]) for r in got.collect()) == [("S1", "H1", "x", "a.csv"), ("S2", "H2", "none", "b.csv")]


def test_strategies_and_edges(spark, tmp_path):
    write(tmp_path, c="junk,line,x\nS1,H1,n1\nSUBSCRIBER_ID,hios_id,note\nS2,H2,n2\nTRL|2,,\n")
    df = files.read_files(spark, str(tmp_path / "c.csv"), files.FileFormat(header=False, multiline=True))
    df = files.without_edges(df, skip_first=1, drop_last=1)
    mapped = files.map_columns(df, Contract(CONTRACT.columns, "POSITION"), headers=["a", "b", "c"])
    assert sorted(r.subscriber_id for r in files.without_repeated_headers(mapped).collect()) == ["S1", "S2"]
    with pytest.raises(ContractError, match="HDR_016"):
        files.without_repeated_headers(mapped, "FAIL")
    all_rows = files.read_files(spark, str(tmp_path / "c.csv"), files.FileFormat(header=False))
    assert files.without_trailer(all_rows, "trl|").count() == 4
    plain = files.map_columns(spark.createDataFrame([(1, 2)], "`A b` int, `c.d` int"), None)
    assert plain.columns == ["a_b", "c_d"]
    with pytest.raises(ContractError, match="HDR_003"):
        files.map_columns(spark.createDataFrame([(1, 2)], "`A b` int, `a.b` int"), None)


def test_json_and_parquet(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    (tmp_path / "j.json").write_text('{"a":1}\n{"a":2}\n')
    assert files.read_files(spark, str(tmp_path / "p"), files.FileFormat("parquet")).count() == 3 and files.read_files(spark, str(tmp_path / "j.json"), files.FileFormat("json"), stamp=False).columns == ["a"]


@pytest.mark.parametrize(("text", "code"), [("\n", "HDR_010"), ("a,,b\n", "HDR_010"), ('a,"b\n', "HDR_011"), ("a,b,a\n", "HDR_002"), ("a;b;c\n", "HDR_009")])
def test_bad_headers(tmp_path, text, code):
    (tmp_path / "f").write_text(text)
    with pytest.raises(intake.IntakeError, match=code):
        intake.read_header(tmp_path / "f")


def test_headers_and_encoding(tmp_path):
    (tmp_path / "f").write_bytes('﻿"a,b",c\r\n'.encode())
    assert intake.read_header(tmp_path / "f") == ["a,b", "c"]
    (tmp_path / "g").write_bytes(b"caf\xe9,b\n")
    with pytest.raises(intake.IntakeError, match="HDR_012"):
        intake.read_header(tmp_path / "g")
    assert intake.read_header(tmp_path / "g", encoding="latin-1") == ["café", "b"]


def test_managed_folders(tmp_path):
    head = "subscriber id,hios_id\n"
    write(tmp_path / "landing", a=head + "S1,H1\n", b=head + "S1,H1\n", c="wrong,header\nx,y\n", d=head, e=head + "S2,H2\n")
    (tmp_path / "landing" / ".hidden").write_text("x")
    log = []
    box = intake.Intake(tmp_path, intake.FileRules(extensions=("csv",)), CONTRACT, record=log.append)
    got = {s.path.name[:1]: s for s in box.stage()}
    assert {k: s.status for k, s in got.items()} == {"a": "VALIDATED", "b": "SKIPPED", "c": "FAILED", "d": "SKIPPED", "e": "VALIDATED"} and "HDR_001" in got["c"].reason and got["a"].fingerprint == got["e"].fingerprint
    assert sorted(p.name for p in (tmp_path / "inprogress").iterdir()) == ["a.csv", "e.csv"] and (tmp_path / "quarantine" / "c.csv").exists()
    again = intake.Intake(tmp_path, box.rules, CONTRACT, record=log.append)
    assert sorted(s.path.name for s in again.stage()) == ["a.csv", "e.csv"]
    again.complete(list(got[k] for k in "ae"))
    assert sorted(p.name for p in (tmp_path / "processed").iterdir()) == ["a.csv", "e.csv"] and len(again.registry) == 2
    write(tmp_path / "landing", a=head + "S1,H1\n")
    reject = intake.Intake(tmp_path, intake.FileRules(on_duplicate="REJECT"), CONTRACT, registry=again.registry, record=log.append)
    assert [s.status for s in reject.stage()] == ["FAILED"]
    write(tmp_path / "landing", a=head + "S1,H1\n")
    approved = intake.Intake(tmp_path, intake.FileRules(on_duplicate="REPROCESS_WITH_APPROVAL"), CONTRACT, registry=again.registry, approved=set(again.registry), record=log.append)
    assert [s.status for s in approved.stage()] == ["VALIDATED"]
    approved.complete([intake.Staged(tmp_path / "inprogress" / "a.csv", "VALIDATED", checksum="x")])
    assert (tmp_path / "processed" / "a_1.csv").exists()


def test_batches_stand_or_fall_together(tmp_path):
    write(tmp_path / "landing", a="subscriber_id,hios_id\nS1,H1\n", c="wrong,header\nx,y\n")
    got = intake.Intake(tmp_path, intake.FileRules(atomicity="BATCH"), CONTRACT, record=lambda x: None).stage()
    assert [s.status for s in got] == ["HELD", "FAILED"] and (tmp_path / "landing" / "a.csv").exists()


def test_checksums_of_many_files(spark, tmp_path):
    write(tmp_path, a="x", b="y")
    got = {r.path[-5:]: r.checksum for r in intake.checksums(spark, [str(tmp_path)]).collect()}
    assert got == {"a.csv": intake.sha256(tmp_path / "a.csv"), "b.csv": intake.sha256(tmp_path / "b.csv")}


def test_sql_text():
    d = sqltext.dialect("sqlserver")
    assert d.quote("dbo.a]b") == "[dbo].[a]]b]" and d.top1("x", "FROM t") == "SELECT TOP 1 x FROM t" and sqltext.dialect("Oracle").top1("x", "FROM t").endswith("FETCH FIRST 1 ROWS ONLY")
    assert Filter("a", "in", [1, 2], "NUMBER").render(d) == "[a] IN (1, 2)" and Filter("a", "LIKE", "o'%").render(d) == "[a] LIKE 'o''%'" and Filter(expression="x > 1").render(d) == "(x > 1)"
    assert Projection("t", source="s").render(d) == "[s] AS [t]" and Projection("t", expression="a+1").render(d) == "(a+1) AS [t]"
    assert sqltext.render_template("SELECT ':a', x::int FROM t WHERE b = :b -- :c\n", {"b": "5"}) == "SELECT ':a', x::int FROM t WHERE b = 5 -- :c\n"
    for bad in (lambda: Filter("a", "OR", 1).render(d), lambda: Filter("a", "IN", []).render(d), lambda: Projection("t").render(d), lambda: sqltext.render_template(":a", {}), lambda: sqltext.render_template("x", {"a": "1"}), lambda: sqltext.dialect("none"), lambda: sqltext.literal("NUMBER", "1 OR 1"), lambda: sqltext.literal("DATE", "soon")):
        with pytest.raises(SqlError):
            bad()
    for good in ("SELECT 1", " with x as (select 1 order by 1 fetch first 1 rows only) select * from x", "SELECT TOP 5 * FROM t ORDER BY a", "SELECT ';' FROM t", "SELECT * FROM (SELECT a FROM t ORDER BY a) q"):
        assert sqltext.single_select(good) == good.strip()
    for bad in ("DELETE FROM t", "SELECT 1; SELECT 2", "SELECT * FROM t ORDER BY a"):
        with pytest.raises(SqlError):
            sqltext.single_select(bad)
    got = sqltext.resolve_parameters({"a": {"value": 5, "type": "NUMBER"}, "b": {"source": "ENVIRONMENT", "key": "X"}, "c": {"source": "RUN_ID"}, "d": {"source": "SECRET_PROVIDER", "key": "k"}, "e": {"default": "z"}}, {"run_id": "r"}, {"X": "y"}, str.upper)
    assert got == {"a": "5", "b": "'y'", "c": "'r'", "d": "'K'", "e": "'z'"}


@pytest.fixture(scope="module")
def derby(spark, tmp_path_factory):
    url = f"jdbc:derby:{tmp_path_factory.mktemp('derby') / 'db'};create=true"
    df = spark.createDataFrame([(i, "EAST" if i % 2 else "WEST", 10 * i, f"2026-01-{i:02d} 00:00:00") for i in range(1, 21)], "ORDER_ID int, REGION string, AMOUNT int, T string").withColumn("UPDATED_TS", F.col("T").cast("timestamp")).drop("T")
    df.write.format("jdbc").option("url", url).option("dbtable", "ORDERS").option("driver", "org.apache.derby.jdbc.EmbeddedDriver").option("createTableColumnTypes", "REGION VARCHAR(10)").mode("overwrite").save()
    return url


def source(url, **k):
    return jdbc.JdbcSource(url, dialect_name="derby", **k)


def test_reading_a_database(spark, derby):
    jdbc.health_check(spark, source(derby))
    assert jdbc.read(spark, source(derby, table="ORDERS")).count() == 20
    s = source(derby, mode="SELECT_QUERY", table="ORDERS", columns=(Projection("id", "ORDER_ID"), Projection("twice", expression="AMOUNT * 2")), filters=(Filter("REGION", "=", "EAST"), Filter("AMOUNT", ">=", 100, "NUMBER")))
    got = jdbc.read(spark, s)
    assert sorted(tuple(r) for r in got.collect()) == [(i, 20 * i) for i in (11, 13, 15, 17, 19)]
    t = source(derby, mode="SQL_TEMPLATE", sql="SELECT ORDER_ID FROM ORDERS WHERE REGION = :r")
    assert jdbc.read(spark, t, parameters={"r": "'WEST'"}).count() == 10
    assert jdbc.read(spark, source(derby, mode="CUSTOM_SQL", sql="SELECT * FROM ORDERS")).count() == 20


def test_partitioned_reads(spark, derby):
    fixed = source(derby, table="ORDERS", partition_column="ORDER_ID", partitions=4, lower_bound="1", upper_bound="20")
    found = source(derby, table="ORDERS", partition_column="ORDER_ID", partitions=4, discover_bounds=True)
    split = source(derby, table="ORDERS", predicates=("ORDER_ID <= 5", "ORDER_ID > 5"))
    for s, n in ((fixed, 4), (found, 4), (split, 2)):
        df = jdbc.read(spark, s)
        assert df.count() == 20 and df.rdd.getNumPartitions() == n
    with pytest.raises(jdbc.JdbcError, match="text"):
        jdbc.read(spark, source(derby, table="ORDERS", partition_column="REGION", partitions=2, discover_bounds=True))
    for bad in (dict(partitions=65), dict(partition_column="A"), dict(mode="X"), dict(mode="INCREMENTAL")):
        with pytest.raises(jdbc.JdbcError):
            source(derby, table="T", **bad)


def test_windows_of_a_database(spark, derby):
    rows = []
    store = wm.WatermarkStore(lambda: spark.createDataFrame(rows, wm.STORE_SCHEMA), rows.append)
    spec = wm.WatermarkSpec(("UPDATED_TS",), ("TIMESTAMP",))
    s = source(derby, mode="INCREMENTAL", table="ORDERS", filters=(Filter("AMOUNT", "<=", 100, "NUMBER"),), watermark=spec, initial=("2026-01-03 00:00:00",))
    reader = jdbc.IncrementalReader(spark, s, store, "orders")
    assert sorted(r.ORDER_ID for r in reader.read("r1").collect()) == [4, 5, 6, 7, 8, 9, 10]
    reader.discard("r1")
    assert store.get("orders") is None and reader.read("r2").count() == 7 and reader.commit("r2")
    assert store.get("orders")[0] == ("2026-01-10 00:00:00",) and reader.read("r3").count() == 0 and not reader.commit("r3")
    more = jdbc.IncrementalReader(spark, source(derby, mode="INCREMENTAL", table="ORDERS", watermark=spec), store, "orders")
    assert sorted(r.ORDER_ID for r in more.read("r4").collect()) == list(range(11, 21)) and more.commit("r4")
    pair = source(derby, mode="INCREMENTAL", table="ORDERS", watermark=wm.WatermarkSpec(("REGION", "ORDER_ID"), ("STRING", "NUMERIC")))
    assert jdbc.capture_upper(spark, pair) == ("WEST", "20")
    clock = source(derby, mode="INCREMENTAL", table="ORDERS", watermark=wm.WatermarkSpec(("UPDATED_TS",), ("TIMESTAMP",), wm.HALF_OPEN), upper_from="SOURCE_CLOCK")
    assert wm.parse("TIMESTAMP", jdbc.capture_upper(spark, clock)[0])
    assert abs(jdbc.clock_drift(spark, clock)) < jdbc.DRIFT_SECONDS
    with pytest.raises(jdbc.JdbcError, match="half-open"):
        source(derby, mode="INCREMENTAL", table="ORDERS", watermark=wm.WatermarkSpec(("UPDATED_TS",), ("TIMESTAMP",), wm.HALF_OPEN))


def test_rows_without_watermark_are_refused_at_first(spark, derby):
    s = source(derby, mode="INCREMENTAL", sql="SELECT ORDER_ID, CASE WHEN ORDER_ID > 1 THEN UPDATED_TS END AS U FROM ORDERS", watermark=wm.WatermarkSpec(("U",), ("TIMESTAMP",)))
    with pytest.raises(jdbc.JdbcError, match="JDBC_006 1 "):
        jdbc.guard_null_watermarks(spark, s)


def test_retry_and_masking():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionResetError("by peer")
        return "ok"

    assert jdbc.with_retry(flaky, sleep=waits.append) == "ok" and len(waits) == 2 and waits[1] > waits[0] / 2
    with pytest.raises(RuntimeError, match="Login"):
        jdbc.with_retry(lambda: (_ for _ in ()).throw(RuntimeError("Login failed")), sleep=waits.append)
    assert jdbc.masked("jdbc:x://u:p@h/db;password=secret;user=me") == "jdbc:x://***@h/db;password=***;user=***"


def test_failures_of_a_driver_are_told_by_state_and_code(spark, derby):
    with pytest.raises(Exception) as bad:  # noqa: PT011
        jdbc.ask(spark, source(derby, table="ORDERS"), "SELECT NOPE FROM ORDERS").collect()
    found = jdbc.sql_failures(bad.value)
    assert found and found[0].state == "42X04" and not jdbc.is_transient(bad.value)
    jvm = spark._jvm
    for made, vendor, passing in (
        (jvm.java.sql.SQLTransientConnectionException("x"), "", True), (jvm.java.sql.SQLNonTransientException("x"), "", False), (jvm.java.sql.SQLException("x", "08S01"), "", True),
        (jvm.java.sql.SQLException("x", "S0001", 1205), "sqlserver", True), (jvm.java.sql.SQLException("x", "S0001", 1205), "oracle", False),
    ):
        assert jdbc.is_transient(type("E", (Exception,), {"java_exception": jvm.java.lang.RuntimeException("wrapped", made)})(), vendor) is passing
    assert jdbc.health_check(spark, source(derby, table="ORDERS"), executors=True) == spark.sparkContext.defaultParallelism
    with pytest.raises(jdbc.JdbcError, match="JDBC_001"):
        jdbc.health_check(spark, source("jdbc:derby:memory:absent", table="T"))


def test_authentication_by_name(spark):
    s = source("jdbc:x", table="T", properties={"user": "u", "password": "p", "token": "t"}, authentication="TOKEN")
    assert jdbc.AUTHENTICATION.get(s.authentication)(s.properties) == {"accessToken": "t"}
    with pytest.raises(ValueError, match="unknown authentication 'magic'; known: integrated, password, token"):
        jdbc.AUTHENTICATION.get("magic")


def test_a_full_load_seeds_the_watermark_once(spark, derby):
    rows = []
    store = wm.WatermarkStore(lambda: spark.createDataFrame(rows, wm.STORE_SCHEMA), rows.append)
    spec = wm.WatermarkSpec(("ORDER_ID",), ("NUMERIC",))
    make = lambda **k: jdbc.IncrementalReader(spark, source(derby, table="ORDERS", watermark=spec, **k), store, "o")
    full = make(filters=(Filter("ORDER_ID", "<=", 12, "NUMBER"),))
    assert full.read("r1").count() == 12 and full.commit("r1") and store.get("o") == (("12",), 1)
    again = make()
    assert again.read("r2").count() == 20 and not again.commit("r2") and store.get("o") == (("12",), 1)
    assert sorted(r.ORDER_ID for r in make(mode="INCREMENTAL").read("r3").collect()) == list(range(13, 21))
    bounded = jdbc.relation(source(derby, table="ORDERS"), wm.upper_sql(spec, ("12",), lambda c: c))
    assert jdbc.ask(spark, source(derby, table="ORDERS"), f"SELECT * FROM {bounded}").count() == 12


def test_topic_ranges_are_pinned_and_committed_with_the_run(spark):
    kept, asked, ends = [], [], {0: 10, 1: 0, 2: 5}
    table = lambda: spark.createDataFrame(kept, kafka.OFFSET_SCHEMA)
    r = kafka.LedgerReader("e", "t", table, lambda df: kept.extend(df.collect()), lambda: dict(ends), lambda a, b: asked.append((a, b)) or spark.range(1))
    assert r.read("r1").count() == 1 and asked == [('{"t":{"0":-2,"2":-2}}', '{"t":{"0":10,"2":5}}')]
    r.discard("r1")
    assert r.position() == {} and r.read("r2") is not None and asked[0] == asked[1] and r.commit("r2", spark) == 2
    ends |= {0: 12, 1: 3}
    r.read("r3")
    assert asked[2] == ('{"t":{"0":10,"1":-2}}', '{"t":{"0":12,"1":3}}') and r.commit("r3", spark) == 2 and r.position() == {0: 12, 1: 3, 2: 5}
    assert r.read("r4") is None and r.commit("r4", spark) == 0
    ends[2] = 1
    with pytest.raises(kafka.RangeError, match="partitions 2 end before"):
        r.read("r5")


def test_topic_records(spark):
    rows = [(b"k1", b'{"id": 1, "tags": ["a"]}', "t", 0, 5, None), (b"k2", None, "t", 0, 6, None), (b"k3", b"not json", "t", 1, 2, None)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp")
    got = {r.kafka_key: (r.kafka_tombstone, r.id, r.tags) for r in kafka.decode(df, "json", "id bigint, tags array<string>").collect()}
    assert got == {"k1": (False, 1, ["a"]), "k2": (True, None, None), "k3": (False, None, None)}
    assert [r.value for r in kafka.decode(df, "string").orderBy("kafka_key").collect()] == ['{"id": 1, "tags": ["a"]}', None, "not json"]
    ranges = {(r.topic, r.partition): (r.from_offset, r.until_offset) for r in kafka.ranges_read(kafka.decode(df, "string"), "e", "r").collect()}
    assert ranges == {("t", 0): (5, 7), ("t", 1): (2, 3)}
    assert kafka.starting_offsets("t", [0, 1], {0: 7}) == '{"t":{"0":7,"1":-2}}' and kafka.parse_offsets('{"t":{"0":7}}') == {"t": {0: 7}}
    for bad in (lambda: kafka.decode(df, "avro"), lambda: kafka.decode(df, "json"), lambda: kafka.decode(df, "json", "Kafka_Offset int")):
        with pytest.raises(ValueError, match="payload|JSON"):
            bad()
    nested = json.dumps({"type": "struct", "fields": [{"name": "id", "type": "long", "nullable": True, "metadata": {}}]})
    assert kafka.decode(df, "json", nested).columns[-1] == "id"


def test_what_has_landed(spark):
    df = spark.createDataFrame([("r1", "f1", "a", "b", None), ("r2", "f2", "c", "d", 1)], "run_id string, file_id string, extract_start_ts string, extract_end_ts string, v int")
    assert raw.decision(df, "r1") == "SKIP_RUN" and raw.decision(df, "r3", ("a", "b")) == "SKIP_WINDOW" and raw.decision(df, "r3", ("a", "b"), held=True) == "APPEND" and raw.decision(df, "r1", force=True) == "APPEND" and raw.decision(df, "r9", ("", "")) == "APPEND"
    assert raw.not_landed(df, df.filter("v IS NULL"), ["v"]).count() == 1
    rest, loaded = raw.without_loaded_files(df, df.filter("run_id = 'r1'"))
    assert [r.file_id for r in rest.collect()] == ["f2"] and [r.file_id for r in loaded.collect()] == ["f1"] and rest.columns == df.columns
    with pytest.raises(ValueError, match="slice"):
        raw.slice_of(df)


def test_registry_and_introspection(spark, derby, tmp_path):
    from sluice.sources import introspect, registry

    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert registry.SOURCES.get("FILE")(spark, path=str(tmp_path / "p"), kind="parquet").count() == 3
    with pytest.raises(registry.UnknownKind, match="file, jdbc, kafka, kafka_stream, table"):
        registry.SOURCES.get("ftp")
    registry.SINKS.get("files")(spark.range(2), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 5
    got = introspect.table_columns(spark, source(derby, table="ORDERS"), "ORDERS")
    assert [(n, t) for n, t, _ in got] == [("ORDER_ID", "int"), ("REGION", "string"), ("AMOUNT", "int"), ("UPDATED_TS", "timestamp")]
    c = introspect.contract_of(got, ("ORDER_ID",))
    assert c.business_keys == ["order_id"] and c.lookup()["updated_ts"].type == "timestamp"
    assert [introspect.spark_type(*a) for a in ((2, 10, 2), (3,), (-155,), (93,), (2004,), (16,), (92,))] == ["decimal(10,2)", "decimal(38,18)", "string", "timestamp", "binary", "boolean", "string"]
    s = source("jdbc:x", mode="INCREMENTAL", table="t", watermark=wm.WatermarkSpec(("u",), ("NUMERIC",)), initial=("5",))
    assert introspect.preview(s) == '(SELECT * FROM "t" WHERE ("u" > 5)) src' and introspect.preview(source("jdbc:x", mode="CUSTOM_SQL")).startswith("-- no preview")
    problems, text = introspect.dry_run({"entity": "e", "source": {"type": "jdbc"}}, s)
    assert problems == ["raw.table is required"] and text


def test_a_feed_is_drafted_from_a_database(spark, derby):
    from sluice.sources import introspect

    s = source(derby, table="KEYED")
    c = spark._jvm.java.sql.DriverManager.getConnection(derby)
    c.createStatement().execute("CREATE TABLE KEYED (B INT NOT NULL, A BIGINT NOT NULL, UPDATED_TS TIMESTAMP NOT NULL, LAST_MODIFIED TIMESTAMP, X VARCHAR(9), PRIMARY KEY (A, B))")
    c.close()
    columns, keys = introspect.table_columns(spark, s, "KEYED"), introspect.primary_key(spark, s, "KEYED")
    assert keys == ["A", "B"] and introspect.primary_key(spark, s, "ORDERS") == []
    d = introspect.draft(columns, keys, "keyed", "KEYED")
    assert d.open == () and d.conf["source"]["incremental"] == {"watermark_column": "UPDATED_TS", "watermark_type": "TIMESTAMP"} and sorted(d.contract.business_keys) == ["a", "b"]
    assert introspect.dry_run(d.conf)[0] == [] and d.conf["raw"]["idempotency_key"] == ["A", "B", "UPDATED_TS"] and d.conf["curated"]["merge"] == {"keys": ["a", "b"], "freshness": {"column": "updated_ts"}}
    two = [*columns, ("CHANGED_TS", "timestamp", False)]
    assert introspect.draft(two, keys, "keyed", "KEYED").open == ("watermark: UPDATED_TS, CHANGED_TS all may be the time of the last change",)
    full = introspect.draft(two, ["A"], "keyed", "KEYED", {"watermark": None, "partitions": 8})
    assert full.open == () and full.conf["source"]["mode"] == "FULL_TABLE" and full.conf["source"]["partitioning"]["column"] == "A"
    none = introspect.draft([("X", "string", True)], [], "x", "X")
    assert len(none.open) == 2 and "curated" not in none.conf and introspect.dry_run(none.conf)[0] == []
    grows = introspect.draft([("ID", "bigint", False)], ["ID"], "x", "X")
    assert grows.conf["source"]["incremental"]["watermark_type"] == "NUMERIC" and grows.open == ()
    with pytest.raises(ValueError, match="NOPE"):
        introspect.draft(columns, keys, "x", "X", {"watermark": "NOPE"})


def test_columns_of_feeds_without_contract(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Sub No` int, `A.b` int, c int")
    assert files.legacy_columns(df, {"sub no": "id"}).columns == ["id", "A.b", "c"] and files.legacy_columns(df, normalize=True).columns == ["sub_no", "a_b", "c"]
    assert tuple(files.legacy_columns(df, {"a_b": "x"}, ["C", "x"]).first()) == (3, 2)
    for bad in (dict(aliases={"c": "a.B"}), dict(columns=["zz"])):
        with pytest.raises(ContractError):
            files.legacy_columns(df, **bad)


def test_edges_of_several_files(spark, tmp_path):
    write(tmp_path, a="h1\nx1\nx2\nt\n", b="h1\nt\n", c="only\n")
    df = files.read_files(spark, str(tmp_path), files.FileFormat(header=False))
    assert sorted(r._c0 for r in files.without_edges(df, 1, 1).collect()) == ["x1", "x2"] and files.without_edges(df, 0, 2).count() == 2 and files.without_edges(df).count() == 7
    plan = files.without_edges(df, 1)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
