import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice.functions.order import OrderError, parse_term, parse_terms
from sluice.operators import keys, merge
from sluice.operators.merge import MergeError, MergeSpec
from sluice.session import small_enough, spread_join, stored_bytes

SPEC = MergeSpec(keys=("k",), freshness="v", tie_breakers=("seq",))
COLUMNS = "k string, v int, seq int, x string, record_hash string, create_timestamp timestamp_ntz, last_modified_op string, flag string, is_deleted boolean"
OLD, NEW = dt.datetime(2020, 1, 1), dt.datetime(2024, 1, 1)


def table(spark, rows, at):
    return spark.createDataFrame([(k, v, s, x, h, at, "I", f, False) for k, v, s, x, h, f in rows], COLUMNS)


def brute(inc, tgt, spec):
    """One row at a time: (row values, outcome) by key."""
    soft = spec.deletes == "SOFT"
    none = lambda n: (n is not None, n or 0)
    out, t = {}, {r[0]: r for r in tgt}
    for k, r in t.items():
        out[k] = ((*r[:5], OLD, "I", r[5], False), "unchanged")
    for r in inc:
        k, dead = r[0], soft and (r[5] or "").strip().lower() in ("y", "1", "true", "d")
        new = (*r[:5], OLD if k in t else NEW, "D" if dead else "U" if k in t else "I", r[5], dead)
        if k not in t:
            out[k] = (new, "deleted" if dead else "inserted")
            continue
        o = t[k]
        if not dead and r[4] is not None and r[4] == o[4]:
            newer = r[1] is not None and o[1] is not None and r[1] > o[1]
            out[k] = ((o[0], r[1] if newer else o[1], r[2] if newer else o[2], *o[3:5], OLD, "I", o[5], False), "ignored")
        elif (none(r[1]), none(r[2])) > (none(o[1]), none(o[2])):
            out[k] = (new, "deleted" if dead else "updated")
        else:
            out[k] = ((*o[:5], OLD, "I", o[5], False), "ignored")
    return sorted(map(repr, out.values()))


def rows(rnd, names):
    number = lambda: rnd.choice([None, 1, 2, 3])
    return [(k, number(), number(), rnd.choice("pq"), rnd.choice([None, "h1", "h2"]), rnd.choice([None, "y", "n", " Y "])) for k in names]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("deletes", ["IGNORE", "SOFT"])
@pytest.mark.parametrize("seed", range(2))
def test_equals_a_loop(spark, small, deletes, seed):
    rnd = random.Random(seed)
    spec = MergeSpec(keys=("k",), freshness="v", tie_breakers=("seq",), deletes=deletes, indicator="flag")
    tgt, inc = rows(rnd, [f"k{i}" for i in range(80)] + [None]), rows(rnd, [f"k{i}" for i in range(40, 120)] + [None])
    m = merge.merge(table(spark, inc, NEW).withColumn("clash", F.lit(1)).repartition(3), table(spark, tgt, OLD).repartition(3), spec, small)
    got = sorted(repr((tuple(r)[:-1], r[-1])) for r in m.collect())
    assert got == brute(inc, tgt, spec)
    n = merge.outcome_counts(m).first()
    assert n.inserted + n.updated + n.deleted + n.ignored == len(inc)


def test_empty_sides(spark):
    some = [("a", 1, 1, "p", None, None)]
    empty, full = table(spark, [], OLD), table(spark, some, NEW)
    for small in (True, False):
        assert [r._outcome for r in merge.merge(empty, full, SPEC, small).collect()] == ["unchanged"]
        assert [r._outcome for r in merge.merge(full, empty, SPEC, small).collect()] == ["inserted"]
        assert merge.merge(empty, empty, SPEC, small).collect() == []
    assert tuple(merge.outcome_counts(merge.merge(empty, empty, SPEC)).first()) == (0, 0, 0, 0)


def test_a_small_batch_does_not_shuffle_the_target(spark):
    tgt = table(spark, [(f"k{i}", 1, 1, "p", None, None) for i in range(50)], OLD)
    inc = table(spark, [("k1", 2, 1, "q", None, None)], NEW)
    plan = merge.merge(inc, tgt, SPEC, True)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_the_plan_follows_the_measured_sizes(spark, tmp_path, monkeypatch):
    """A full outer join reads each side once; only a stored large target and a small batch make it a broadcast, and the batch is evaluated once."""
    table(spark, [(f"k{i}", 1, 1, "p" * 500, None, None) for i in range(500)], OLD).write.parquet(str(tmp_path / "t"))
    tgt, seen = spark.read.parquet(str(tmp_path / "t")), spark.sparkContext.accumulator(0)

    def batch(width):
        def count(rows):
            for b in rows:
                seen.add(b.num_rows)
                yield b

        rows = table(spark, [(f"k{i}", 2, 1, "q" * width, None, None) for i in range(490, 510)], NEW).coalesce(1)
        return rows.mapInArrow(count, rows.schema)

    plan = lambda m: m._jdf.queryExecution().executedPlan().toString()
    assert stored_bytes(tgt.filter("v = 1").select("k")) == stored_bytes(tgt) > 1_000 and stored_bytes(tgt.distinct()) == stored_bytes(spark.range(5)) == 0
    whole = merge.merge(batch(1), tgt, SPEC)
    assert plan(whole).count("FileScan") == 1 and "BroadcastHashJoin" not in plan(whole)
    want = sorted(map(repr, whole.collect()))
    monkeypatch.setattr(merge, "LARGE_TARGET", 0)
    seen.value = 0
    near = merge.merge(batch(1), tgt, SPEC)
    assert "SortMergeJoin" not in plan(near) and plan(near).count("FileScan") == 2 and sorted(map(repr, near.collect())) == want and seen.value == 20
    monkeypatch.setattr("sluice.session.BROADCAST_BYTE_CAP", 10_000)
    assert small_enough(batch(100)) and not small_enough(batch(1_000)) and not small_enough(batch(1).withColumn("a", F.array(F.lit("z" * 1_000))))
    assert "BroadcastHashJoin" not in plan(merge.merge(batch(1_000), tgt, SPEC))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_spread(spark, how):
    big = spark.range(3_000).selectExpr("id", "IF(id % 3 = 0, 'hot', IF(id % 50 = 1, NULL, CAST(id % 40 AS STRING))) AS k")
    other = spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 3), (None, 4)], "k string, x int")
    want = sorted(map(tuple, big.join(other, "k", how).select("id", "x").collect()), key=str)
    for most in (100, 10**6):
        got = spread_join(big, other, ["k"], how, hot_rows=most)
        assert sorted(map(tuple, got.select("id", "x").collect()), key=str) == want and set(got.columns) == {"k", "id", "x"}
    spread = spread_join(big.repartition(4), other, ["k"], how, hot_rows=100)
    assert spread.filter("k = 'hot'").count() == 2_000


def test_union_trap_stays_away(spark):
    """Inputs that are themselves deduplicated by the key, in every plan."""
    raw = spark.range(15000).selectExpr("id", "id % 1500 AS k", "pmod(hash(id), 2000) AS v")
    inc = keys.latest_per_key(raw.filter("id % 3 = 0"), ["k"], "v,id")
    tgt = keys.latest_per_key(raw.filter("id % 3 <> 0 AND k % 10 <> 0"), ["k"], "v,id")
    spec = MergeSpec(keys=("k",), freshness="v", tie_breakers=("id",))
    want = {r.k: r.id for r in inc.collect()}
    for r in tgt.collect():
        o = want.get(r.k)
        if o is None or (r.v, r.id) >= (pmod(spark, o), o):
            want[r.k] = r.id
    for small in (True, False):
        got = [(r.k, r.id) for r in merge.merge(inc, tgt, spec, small).collect()]
        assert len(got) == len(want) and dict(got) == want


def pmod(spark, i, seen={}):  # noqa: B006
    if not seen:
        seen.update({r.id: r.v for r in spark.range(15000).selectExpr("id", "pmod(hash(id), 2000) AS v").collect()})
    return seen[i]


def test_specifications_that_lose_rows_are_refused():
    for bad in (dict(strategy="LAST_WRITE_WINS"), dict(), dict(freshness="v", deletes="CDC"), dict(freshness="v", deletes="SOFT"), dict(freshness="v", deletes="FULL_SNAPSHOT_ABSENCE"), dict(freshness="v", strategy="X")):
        with pytest.raises(MergeError):
            MergeSpec(keys=("k",), **bad)
    assert merge.resolve_keys(None, ["a"]) == ["a"] and merge.resolve_keys([], ["a"]) == [] and merge.resolve_keys(["A"], ["a"]) == ["A"]
    with pytest.raises(MergeError, match="HDR_017"):
        merge.resolve_keys(["b"], ["a"])


def test_missing_and_unorderable_columns(spark):
    tgt = table(spark, [], OLD)
    with pytest.raises(OrderError, match="HDR_019"):
        merge.merge(tgt, tgt, MergeSpec(keys=("k",), freshness="nope"))
    nested = tgt.withColumn("v", F.array(F.lit(1)))
    with pytest.raises(MergeError, match="CUR_008"):
        merge.merge(nested, nested, SPEC)
    bad = table(spark, [("a", 1, 1, "p", None, "x")], OLD)
    with pytest.raises(MergeError, match="can't be read"):
        merge.check_freshness(bad, MergeSpec(keys=("k",), freshness="x", compare_as="int"))


def test_absence_keeps_tombstones_and_revives(spark):
    spec = MergeSpec(keys=("k",), deletes="FULL_SNAPSHOT_ABSENCE", confirm_complete_extract=True)
    tgt = table(spark, [("a", 1, 1, "p", None, None), ("b", 1, 1, "p", None, None), ("c", 1, 1, "p", None, None)], OLD).withColumn("last_modified_op", F.when(F.col("k") != "a", "D").otherwise("I"))
    got = {r.k: (r.last_modified_op, r.is_deleted, r._outcome) for r in merge.full_publish(table(spark, [("b", 2, 1, "p", None, None)], NEW), tgt, spec).collect()}
    assert got == {"a": ("D", True, "absent"), "b": ("I", False, "inserted"), "c": ("D", True, "unchanged")}


def test_partition_slices_by_literals_and_by_join(spark):
    tgt = spark.createDataFrame([("a", 1, "x"), ("b", 1, None), ("c", 1, "z")], "k string, v int, p string")
    parts = spark.createDataFrame([("x",), (None,)], "p string")
    for cap in (10, 1):
        assert sorted(r.k for r in merge.partition_slice(tgt, parts, cap).collect()) == ["a", "b"]
    assert merge.partition_slice(tgt, parts.limit(0)).count() == 0
    with pytest.raises(MergeError, match="CUR_006"):
        merge.null_partitions(tgt, ["p"], "REJECT")
    assert merge.null_partitions(tgt, ["p"], "HIVE").count() == 3


def test_order_terms():
    t = parse_term("a ASC nulls_first as Decimal(10,2)")
    assert (t.column, t.ascending, t.nulls_first, t.kind) == ("a", True, True, "decimal(10,2)")
    assert [x.column for x in parse_terms("a desc as decimal(10,2),b")] == ["a", "b"] and parse_terms(None) == [] and parse_terms("") == []
    for bad in ("", "a up", "a asc desc", "a nulls_first nulls_last", "a as", "a as nothing", "a as int desc"):
        with pytest.raises(OrderError, match="HDR_020"):
            parse_term(bad)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), (None, 1, "n"), (None, 3, "m"), ("b", None, "z")], "`k.1` string, v int, x string")
    got = {(r[0], r[1]) for r in keys.latest_per_key(df, ["k.1"], "v").collect()}
    assert got == {("a", 2), (None, 3), ("b", None)}
    with pytest.raises(OrderError, match="CUR_004"):
        keys.latest_per_key(df, ["k.1"], "", require_order=True)
    plan = keys.latest_per_key(df, ["k.1"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
