import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st

from sluice.operators import watermark as wm
from sluice.operators.watermark import WatermarkError, WatermarkSpec

TS = WatermarkSpec(("ts",), ("TIMESTAMP",))
PAIR = WatermarkSpec(("ts", "id"), ("TIMESTAMP", "NUMERIC"))


@given(st.lists(st.text(max_size=8), min_size=1, max_size=4))
def test_codec_round_trip(parts):
    assert list(wm.deserialize(wm.serialize(parts))) == parts


def test_codec_text():
    assert wm.serialize(["a|b", "c\\d"]) == "a\\|b|c\\\\d" and wm.deserialize("x") == ("x",) and wm.deserialize("") == ("",)


def test_rendering():
    assert wm.render("TIMESTAMP", "2026-01-02 03:04:05") == "2026-01-02 03:04:05.0" and wm.render("TIMESTAMP", "2026-01-02 03:04:05.1200") == "2026-01-02 03:04:05.12"
    assert wm.render("DATETIMEOFFSET", "2026-01-02T03:04:05.123Z") == "2026-01-02 03:04:05.1230000 +00:00"
    assert wm.render("DATETIMEOFFSET", "2026-01-02 03:04:05 -05:30") == "2026-01-02 03:04:05.0000000 -05:30"
    assert wm.render("ROWVERSION", "0xff") == "00000000000000FF" and wm.literal("ROWVERSION", "ff") == "0x00000000000000FF" and wm.literal("STRING", "o'x") == "'o''x'" and wm.literal("NUMERIC", " 5.0 ") == "5.0"


@pytest.mark.parametrize(("kind", "text"), [("NUMERIC", "1; DROP"), ("NUMERIC", "NaN"), ("DATE", "2026-02-30"), ("DATE", "20260201"), ("TIMESTAMP", "2026-01-01"), ("TIMESTAMP", "2026-01-01 25:00:00"), ("DATETIMEOFFSET", "2026-01-01 00:00:00"), ("ROWVERSION", "xyz"), ("ROWVERSION", "00112233445566778")])
def test_rubbish_never_becomes_sql(kind, text):
    with pytest.raises(WatermarkError, match="JDBC_004"):
        wm.literal(kind, text)


def test_order():
    one = lambda k, a, b: wm.compare(WatermarkSpec(("c",), (k,)), (a,), (b,))
    assert one("NUMERIC", "9", "10") == -1 and one("STRING", "9", "10") == 1 and one("ROWVERSION", "80", "7F") == 1 and one("DATETIMEOFFSET", "2026-01-01 01:00:00 +01:00", "2026-01-01T00:00:00Z") == 0
    assert wm.compare(PAIR, ("2026-01-01 00:00:00", "2"), ("2026-01-01 00:00:00", "10")) == -1 and wm.later(TS, ("2026-01-01 00:00:00.1",), ("2026-01-01 00:00:00.09",)) == ("2026-01-01 00:00:00.1",)


def test_overlap():
    assert wm.overlapped("TIMESTAMP", "2026-03-29 03:00:00", Decimal(3600)) == "2026-03-29 02:00:00.0" and wm.overlapped("TIMESTAMP", "2026-01-01 00:00:00", Decimal("0.5")) == "2025-12-31 23:59:59.5"
    assert wm.overlapped("DATE", "2026-03-01", Decimal(1)) == "2026-02-28" and wm.overlapped("NUMERIC", "5", Decimal(7)) == "-2" and wm.overlapped("ROWVERSION", "05", Decimal(7)) == "0" * 16
    assert wm.overlapped("DATETIMEOFFSET", "2026-01-01 00:00:00 +02:00", Decimal(60)) == "2025-12-31 23:59:00.0000000 +02:00"
    with pytest.raises(WatermarkError):
        wm.overlapped("STRING", "x", Decimal(1))


def test_sql():
    assert wm.window_sql(TS, ("2026-01-01 00:00:00",), ("2026-02-01 00:00:00",)) == "(ts > '2026-01-01 00:00:00.0') AND NOT (ts > '2026-02-01 00:00:00.0')"
    half = WatermarkSpec(("ts",), ("TIMESTAMP",), wm.HALF_OPEN, Decimal(60))
    assert wm.window_sql(half, ("2026-01-01 00:00:00",), ("2026-02-01 00:00:00",)) == "(ts >= '2025-12-31 23:59:00.0') AND NOT (ts >= '2026-02-01 00:00:00.0')"
    assert wm.predicate_sql(PAIR, ("2026-01-01 00:00:00", "5"), lambda c: f"[{c}]") == "(([ts] > '2026-01-01 00:00:00.0') OR ([ts] = '2026-01-01 00:00:00.0' AND [id] > 5))"
    for bad in (lambda: WatermarkSpec(("a", "b"), ("DATE", "DATE"), wm.HALF_OPEN), lambda: WatermarkSpec(("a",), ("X",)), lambda: WatermarkSpec((), ()), lambda: wm.predicate_sql(PAIR, ("2026-01-01 00:00:00",))):
        with pytest.raises(WatermarkError):
            bad()


@pytest.mark.parametrize("spec", [TS, WatermarkSpec(("ts",), ("TIMESTAMP",), wm.HALF_OPEN)])
def test_windows_tile_without_gap_or_repeat(spark, spec):
    at = [dt.datetime(2026, 1, 1) + dt.timedelta(hours=h) for h in (0, 0, 5, 12, 12, 23, 24, 36)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*at, None])], "id int, ts timestamp_ntz")
    edges = [("2025-12-31 00:00:00",), ("2026-01-01 00:00:00",), ("2026-01-01 12:00:00",), ("2026-01-02 00:00:00",), ("2026-01-03 00:00:00",)]
    got = [r.id for a, b in zip(edges, edges[1:], strict=False) for r in wm.window(df, spec, a, b).collect()]
    assert sorted(got) == list(range(8)) and wm.window(df, spec, None, edges[-1]).count() == 8


def test_highest_and_nulls(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1), 5), (dt.datetime(2026, 1, 1), 7), (dt.datetime(2026, 1, 2), None), (None, 9)], "ts timestamp_ntz, id int")
    assert [tuple(r) for r in wm.highest(df, PAIR).collect()] == [(dt.datetime(2026, 1, 1), 7)] and wm.highest(df.limit(0), PAIR).count() == 0
    assert tuple(wm.null_watermarks(df, PAIR).first()) == (4, 2)


def test_store_is_compare_and_set(spark):
    rows = []
    store = wm.WatermarkStore(lambda: spark.createDataFrame(rows, wm.STORE_SCHEMA), rows.append)
    assert store.get("e") is None and store.advance(TS, "e", ("2026-01-01 00:00:00",), "r1", None)
    assert store.get("e") == (("2026-01-01 00:00:00",), 1) and not store.advance(TS, "e", ("2025-01-01 00:00:00",), "r2", 1)
    with pytest.raises(WatermarkError, match="JDBC_005"):
        store.advance(TS, "e", ("2026-05-01 00:00:00",), "r3", None)
    assert store.advance(TS, "e", ("2026-05-01 00:00:00",), "r3", 1) and store.get("e")[1] == 2
    rows.append(rows[-1])
    with pytest.raises(WatermarkError, match="written 2 times"):
        store.get("e")
