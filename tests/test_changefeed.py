import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import changefeed as cf

FEED = cf.ChangeFeed("subscriber_id", "last_modified_ts", "source_sequence_number", "last_modified_op", "rec_id", ("hios_id", "amount"))
SCHEMA = "rec_id bigint, subscriber_id string, hios_id string, amount bigint, source_sequence_number bigint, last_modified_ts timestamp_ntz, last_modified_op string, key string, ts string"
DAY = dt.datetime(2026, 1, 1)


def brute(rows):
    """Replays in order, row by row; copies of a change complement each other, the earliest landing first."""
    changes = {}
    for r in sorted(rows, key=lambda r: r[0]):
        key = "".join(c for c in (r[1] or "") if c.isalnum()).upper()
        if not key or r[4] is None:
            continue
        at = (r[5] or dt.datetime.min, r[4])
        op = (r[6] or "").strip().upper()
        kind = 2 if op in ("D", "DELETE") else 1 if op in ("I", "INSERT") else 0
        c = changes.setdefault((key, *at), {"kind": 0, "v": [None, None], "key": key, "seq": r[4]})
        c["kind"] = max(c["kind"], kind)
        if kind != 2:
            c["v"] = [a if a is not None else b for a, b in zip(c["v"], (r[2], r[3]), strict=True)]
    state = {}
    for k in sorted(changes, key=lambda k: k[1:]):
        c = changes[k]
        if c["kind"] == 2:
            state.pop(c["key"], None)
        else:
            old = [None, None] if c["kind"] == 1 or c["key"] not in state else state[c["key"]][1]
            state[c["key"]] = (c["seq"], [n if n is not None else o for n, o in zip(c["v"], old, strict=True)])
    return {(k, s, *v) for k, (s, v) in state.items()}


def run(spark, rows, partitions=3, state=None):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(partitions)
    return cf.apply_changes(df, FEED, state)


def found(state):
    return {tuple(r) for r in cf.live(state, FEED).collect()}


def feed(n, seed, hot=0.4):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "S1" if rnd.random() < hot else f"S{rnd.randrange(2, 30)}"
        key = rnd.choice([key, key.lower(), f" {key} ", f"{key[0]}-{key[1:]}"])
        at = None if rnd.random() < 0.1 else DAY + dt.timedelta(days=rnd.randrange(6))
        rows.append((i, key, rnd.choice([None, "A", "B", "C"]), rnd.choice([None, 1, 2, 3]), 1000 + i, at, rnd.choice(["I", "insert", "U", "UPSERT", "d", "DELETE", None, " U "])))
    again = [(n + j, *rows[j][1:]) for j in range(0, n, 5)]
    rows += again + [(9_000, None, "A", 1, 5, DAY, "I"), (9_001, " ", "A", 1, 6, DAY, "I"), (9_002, "S5", "A", 1, None, DAY, "I")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_equals_replay_row_by_row(spark, seed):
    rows = feed(300, seed)
    assert found(run(spark, rows, partitions=5)) == brute(rows)


def test_batches_in_any_order_and_again_give_the_same(spark):
    rows = feed(200, 9)
    state = None
    for part in (rows[120:], rows[:120], rows[50:150]):
        state = run(spark, part, state=state).checkpoint()
    assert found(state) == brute(rows)


def test_late_change_does_not_revive_a_deleted_key(spark):
    state = run(spark, [(1, "a", "X", 1, 10, DAY, "I"), (2, "a", None, None, 20, DAY + dt.timedelta(days=2), "D")])
    later = run(spark, [(3, "A", "Y", 2, 15, DAY + dt.timedelta(days=1), "U")], state=state)
    assert found(later) == set()
    assert {r.kind for r in later.collect()} == {cf.DELETE}


def test_null_time_is_earliest_and_sequence_breaks_ties(spark):
    got = found(run(spark, [(1, "a", "X", 1, 99, None, "D"), (2, "a", "Y", None, 1, DAY, "U"), (3, "b", "P", 1, 2, DAY, "I"), (4, "b", None, 5, 3, DAY, "U")]))
    assert got == {("A", 1, "Y", None), ("B", 3, "P", 5)}


def test_empty_feed(spark):
    assert run(spark, []).count() == 0


def test_hot_key_sends_one_state_per_partition(spark):
    rows = [(i, "hot", "A", i, i + 1, DAY, "U") for i in range(3000)]
    lifted = cf.lift(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA).repartition(4), FEED)
    plan = cf.replay(lifted, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and plan.count("hashpartitioning(key") == 1
    assert found(cf.replay(lifted, 2)) == {("HOT", 3000, "A", 2999)}


def test_very_long_values(spark):
    got = cf.live(run(spark, [(1, "a", "x" * 200_000, 1, 1, DAY, "I")]), FEED).select(F.length("hios_id")).first()[0]
    assert got == 200_000
