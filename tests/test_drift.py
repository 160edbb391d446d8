import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice.functions.text import normalize_header, spark_type_name
from sluice.operators import drift
from sluice.operators.ordered import previous_row

DAY = dt.datetime(2026, 1, 1)
HEADERS = "header_id bigint, entity string, event_ts timestamp_ntz, actual_source_headers string, actual_source_types string, cols string, extra string"


def headers(spark, rows):
    return spark.createDataFrame([(i, e, t, h, k, "clash", "x") for i, e, t, h, k in rows], HEADERS)


@pytest.fixture(scope="module")
def contract(spark):
    return spark.createDataFrame([("m", "subscriber_id", "sub no|mbr key"), ("m", "amount", "amt"), ("c", "claim_id", None)], "entity string, column_name string, aliases string")


def test_each_kind_of_change(spark, contract):
    rows = [
        (1, "m", DAY, "Sub No,amount,x", "string|int|date"),
        (2, "m", DAY + dt.timedelta(days=1), None, None),
        (3, "m", DAY + dt.timedelta(days=2), "X,MBR-KEY,amt", "date|varchar(40)|bigint"),
        (4, "m", DAY + dt.timedelta(days=2), " subscriber.id ,amt", "STRING|long"),
        (5, "c", DAY, "claim id", "string"),
        (6, "m", DAY + dt.timedelta(days=3), "  ", ""),
        (7, "m", DAY + dt.timedelta(days=4), "amt,subscriber_id,New One", "BIGINT|text|decimal(10, 2)"),
    ]
    got = {tuple(r) for r in drift.header_changes(headers(spark, rows), contract).collect()}
    assert got == {(3, "subscriber_id", "renamed"), (3, "amount", "renamed"), (3, "amount", "retyped"), (4, "subscriber_id", "renamed"), (4, "x", "removed"), (7, "new_one", "added")}


def test_empty_tables(spark, contract):
    assert drift.header_changes(headers(spark, []), contract).count() == 0
    only = headers(spark, [(1, "m", DAY, "a,b", "int|int"), (2, "m", DAY, "a", "bigint")])
    assert {tuple(r) for r in drift.header_changes(only, contract.limit(0)).collect()} == {(2, "b", "removed"), (2, "a", "retyped")}


@pytest.mark.parametrize("n", [1, 2, 400])
def test_previous_row_equals_a_loop(spark, n):
    rnd = random.Random(n)
    rows = [(rnd.choice(["hot", "hot", "hot", "b", None]), rnd.randrange(20) if rnd.random() < 0.9 else None, i) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, t int, i int")
    got = {r.i: r.before and r.before.i for r in previous_row(df, ["g"], ["t", "i"], ["i"], "before").collect()}
    want, last = {}, {}
    for g, _, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        want[i] = last.get(g)
        last[g] = i
    assert got == want


@pytest.mark.parametrize(
    ("text", "name"),
    [("INTEGER", "int"), ("Long", "bigint"), ("numeric(10,2)", "decimal(10,2)"), ("DECIMAL(10, 2)", "decimal(10,2)"), ("dec(5)", "decimal(5,0)"), ("decimal", "decimal(10,0)"), ("VARCHAR(120)", "string"), ("char(3)", "string"), (" Timestamp ", "timestamp"), ("real", "float"), ("array<int>", "array")],
)
def test_type_names(spark, text, name):
    got = spark.range(1).select(spark_type_name(F.lit(text))).first()[0]
    assert got == name or got.startswith(name)


def test_header_normalization():
    assert [normalize_header(h) for h in (" Subscriber/Id_", "st.cd", "__A--b  C__", "é", "")] == ["subscriber_id", "st_cd", "a_b_c", "", ""]


def test_consistent_table_has_branches_where_types_conflict(spark, contract):
    h = drift.header_columns(headers(spark, [(1, "m", DAY, "sub no,amount", "string|int"), (2, "m", DAY, "amt,x", "string|date"), (3, "m", DAY, None, None)]), contract)
    rows = spark.createDataFrame([(10, 1, 0, ["S1", " 5 "]), (11, 2, 0, ["7,5", ""]), (12, 3, 0, ["?"]), (13, 1, 1, None), (14, 2, 1, ["8"]), (15, 99, 0, ["z"])], "file_row_id bigint, header_id bigint, row_idx bigint, cell_values array<string>")
    t = {r.file_row_id: r.asDict() for r in drift.consistent_table(rows, h).collect()}
    assert set(t) == {10, 11, 12, 13, 14, 15}
    assert (t[10]["subscriber_id"], t[10]["amount"], t[10]["amount__int"], t[10]["amount__string"]) == ("S1", "5", 5, None)
    assert (t[11]["amount"], t[11]["amount__int"], t[11]["amount__string"], t[11]["x"]) == ("7,5", None, "7,5", None)
    assert t[12]["amount"] is None and t[13]["subscriber_id"] is None and t[14]["amount"] == "8" and t[15]["entity"] is None
    fused = {(r.entity, r.col): (r.canonical_type, [a.type for a in r.alternatives]) for r in drift.fused_schema(h).collect()}
    assert fused[("m", "amount")] == ("string", ["int", "string"]) and fused[("m", "x")] == ("date", ["date"])
