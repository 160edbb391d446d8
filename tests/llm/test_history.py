import random
import re

import numpy as np
import pytest

from sluice.llm import history as h

SAMPLE = "path string, content string, class string, n int"


def lines_of(text):
    return frozenset(x for line in (text or "").split("\n") if (x := re.sub(r"\s+", "", line).lower()))


def brute(deliveries, accepted, samples):
    content = {p: lines_of(t) for p, t in samples}
    sums = {s for s, _ in accepted if s}
    sets = [content[p] for _, p in accepted if content.get(p)]
    out = set()
    for i, _, s, p in sorted(deliveries, key=lambda d: (d[1] is not None, d[1] or 0, d[0])):
        own = content.get(p)
        if s and s in sums:
            out.add((i, "exact"))
        elif own and any(len(own & o) >= 0.8 * len(own | o) - 1e-9 for o in sets):
            out.add((i, "near"))
        else:
            sums |= {s} if s else set()
            sets += [own] if own else []
    return out


def run(spark, deliveries, accepted, samples):
    d = spark.createDataFrame(deliveries, "id bigint, ts bigint, checksum string, path string").repartition(3)
    a = spark.createDataFrame(accepted, "checksum string, path string")
    s = spark.createDataFrame([(*x, "c", 1) for x in samples], SAMPLE)
    return {tuple(r) for r in h.repeated_deliveries(d, a, s).collect()}


def mutate(rnd, lines, k):
    out = list(lines)
    for _ in range(k):
        how = rnd.randrange(4)
        if how == 0 and out:
            out.pop(rnd.randrange(len(out)))
        elif how == 1:
            out.insert(rnd.randrange(len(out) + 1), f"new {rnd.random()}")
        elif how == 2 and out:
            out[rnd.randrange(len(out))] = f"changed {rnd.random()} " + "y" * rnd.choice([5, 300])
        else:
            rnd.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_sequential_rule(spark, seed):
    rnd = random.Random(seed)
    bases = [[f"base {b} line {i} " + "z" * rnd.choice([3, 40, 700]) for i in range(rnd.choice([1, 2, 4, 5, 10, 20]))] + ["Header, of all"] for b in range(8)]
    samples, deliveries, accepted = [], [], []
    for i in range(140):
        b = 0 if rnd.random() < 0.34 else rnd.randrange(8)
        lines = mutate(rnd, bases[b], rnd.choice([0, 0, 1, 1, 2, 3, 5]))
        text = "\n".join(x.upper() if rnd.random() < 0.1 else f"  {x}\t\r" for x in lines)
        samples.append((f"p{i}", rnd.choice([text, text, text, text, text, "", None, " \n "])))
        s = rnd.choice([None, f"k{i}", f"k{i}", f"k{i % 7}"])
        if i < 40:
            accepted.append((s, f"p{i}"))
        else:
            deliveries.append((i, rnd.choice([None, *range(5)]), s, f"p{i}" if rnd.random() < 0.95 else "nowhere"))
    want = brute(deliveries, accepted, samples)
    assert run(spark, deliveries, accepted, samples) == want and {k for _, k in want} == {"exact", "near"}


def test_chains_are_decided_in_order(spark):
    """Each file is near the one before only; every second one is accepted."""
    base = [f"l{i}" for i in range(20)]
    samples = [(f"p{i}", "\n".join(base[2 * i :] + [f"n{j}" for j in range(2 * i)])) for i in range(8)]
    deliveries = [(i, i, None, f"p{i}") for i in range(8)]
    got = run(spark, deliveries, [], samples)
    assert got == brute(deliveries, [], samples) and got == {(i, "near") for i in (1, 3, 5, 7)}


def test_empty_tables(spark):
    assert run(spark, [], [("a", "p")], [("p", "x")]) == set()
    assert run(spark, [(1, 1, "a", "p"), (2, 2, "a", "q")], [], []) == {(2, "exact")}


def test_repeated_rows_and_paths(spark):
    text = "a\nb\nc\nd\ne"
    got = run(spark, [(1, 1, None, "p"), (2, 2, None, "q"), (2, 2, None, "q")], [], [("p", text), ("p", text), ("q", text)])
    d = spark.createDataFrame([(1, 1, None, "p"), (2, 2, None, "q"), (2, 2, None, "q")], "id bigint, ts bigint, checksum string, path string")
    s = spark.createDataFrame([("p", text), ("p", text), ("q", text)], "path string, content string")
    a = spark.createDataFrame([], "checksum string, path string")
    assert got == {(2, "near")} and h.repeated_deliveries(d, a, s).count() == 1


def test_copies_never_become_pairs(spark):
    """Ten thousand copies, a third of them under one checksum, are decided by two representatives."""
    deliveries = [(i, i, "hot" if i % 3 == 0 else f"k{i}", "p") for i in range(10_000)]
    got = run(spark, deliveries, [], [("p", "a\nb\nc")])
    assert len(got) == 9_999 and {k for i, k in got if i % 3} == {"near"} and {k for i, k in got if i % 3 == 0} == {"exact"}


def by_line(*lines):
    keys = h.chunk_lines(list(lines))
    return np.split(keys, np.flatnonzero(np.diff(h._line_numbers(keys))) + 1)


def test_chunks_are_cut_by_content():
    rnd = random.Random(1)
    line = bytes(rnd.randrange(97, 123) for _ in range(20_000))
    (a,), (b,) = by_line(line), by_line(line[:9_000] + b"insert" + line[9_000:])
    lengths = a & h._LENGTHS
    assert lengths.sum() == len(line) and lengths.max() <= h.MAX_CHUNK and len(set(a) & set(b)) > 0.9 * len(a) > 300
    assert (by_line(b"another line, " * 9, line, b"x")[1] == a).all()  # whatever stands beside it
    assert len(by_line(b"short")[0]) == 1 and len(by_line(b"a" * 5_000)[0]) >= 5


def test_ordinary_lines_are_cut():
    lines = [f"s{i:010d},{i * 7919 % 99999:05d}a{i % 9999:04d},2026-06-{i % 28 + 1:02d},{i * 31 % 5000}".encode() for i in range(500)]
    assert len(h.chunk_lines(lines)) > 1.4 * len(lines)


def test_coverage_never_refuses_near_files(spark):
    rnd = random.Random(3)
    near = []
    for _ in range(300):
        base = [("x" if rnd.random() < 0.3 else "") + f"{rnd.randrange(40)} row " * rnd.choice([1, 1, 2, 30]) + str(rnd.random()) for _ in range(rnd.randrange(1, 15))]
        texts = ["\n".join(mutate(rnd, base, rnd.choice([0, 1, 2]))) for _ in range(2)]
        a, b = map(lines_of, texts)
        if a and b and len(a & b) >= 0.8 * len(a | b):
            near += texts
    got = h.chunked(spark.createDataFrame(list(enumerate(near)), "path int, content string").selectExpr("cast(path AS string) AS path", "content"), "path", "content").collect()
    rows = sorted(got, key=lambda r: int(r.path))
    assert len(rows) == len(near) > 100
    for a, b in zip(rows[::2], rows[1::2], strict=True):
        assert sum(k & h._LENGTHS for k in set(a["keys"]) & set(b["keys"])) >= max(a.least, b.least)


def test_frequent_chunks_are_counted_whole(spark):
    values = [1] * 5 + [2] + [3] * 3 + [4, 5] + [6] * 40 + [7]
    df = spark.createDataFrame([(v,) for v in values], "h bigint")
    for parts in (1, 3):
        got = h.frequent_chunks(df.repartition(parts, "h").sortWithinPartitions("h")).collect()
        assert sorted(map(tuple, got)) == [(1, 5), (3, 3), (6, 40)]
    assert h.frequent_chunks(df.limit(0)).count() == 0


CHUNKED = "path string, content string"


def test_store_finds_near_records_of_earlier_batches(spark, tmp_path):
    store = h.ChunkStore(spark, str(tmp_path))
    make = lambda rows: h.chunked(spark.createDataFrame(rows, CHUNKED), "path", "content")
    text = "\n".join(f"l{i}" for i in range(10))
    store.append("1", make([("a", text), ("b", "other")]))
    store.append("1", make([("a", text), ("b", "other")]))
    store.append("2", make([("c", "third")]))
    assert store.records().count() == 3 and store.without("1").records().count() == 1
    new = make([("x", text + "\nextra"), ("y", "unlike")])
    near = store.near(new, h.picked_chunks(new, store.frequent(), 0.8)).collect()
    assert [r.cid for r in near] == [new.filter("path = 'x'").select(h._cid()).first()[0]]


def test_batches_meet_the_store_and_not_old_contents(spark, tmp_path):
    """The second batch names no old file and brings no old content; repeating it changes nothing."""
    store = h.ChunkStore(spark, str(tmp_path))
    text = lambda k, extra: "\n".join([f"{k} line {i}" for i in range(12)] + extra)

    def batch(name, deliveries, samples):
        d = spark.createDataFrame(deliveries, "id bigint, ts bigint, checksum string, path string")
        a = spark.createDataFrame([], "checksum string, path string")
        s = spark.createDataFrame(samples, CHUNKED)
        return {tuple(r) for r in h.repeated_deliveries(d, a, s, store=store, batch=name).collect()}

    assert batch("one", [(1, 1, None, "a"), (2, 2, None, "b")], [("a", text("a", [])), ("b", text("b", []))]) == set()
    second = ([(3, 3, None, "c"), (4, 4, None, "d"), (5, 5, None, "e")], [("c", text("a", ["new"])), ("d", text("d", [])), ("e", text("e", []))])
    for _ in range(2):
        assert batch("two", *second) == {(3, "near")}
        assert sorted(store.batches()) == ["one", "one-before", "two", "two-before"] and store.records().count() == 4
    assert batch("three", [(6, 6, None, "f")], [("f", text("d", ["x", "y"]))]) == {(6, "near")}


@pytest.mark.parametrize("bounds", [(0, 10**6), (10**6, 0)])
def test_rounds_of_leaders_decide_alike(spark, monkeypatch, bounds):
    monkeypatch.setattr(h._accept_in_order, "__defaults__", bounds)
    test_equals_the_sequential_rule(spark, 11)
    test_chains_are_decided_in_order(spark)


def test_what_is_everywhere_is_not_looked_up(spark):
    """Files of a header, a row and a trailer are looked up by the row; larger ones by as many rows as may differ and two."""
    texts = [("\n".join(["the header", f"row {i} of many", "the trailer"])) for i in range(300)] + ["\n".join(["the header", *(f"line {k}" for k in range(20)), "the trailer"])]
    records = h.chunked(spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], CHUNKED), "path", "content").cache()
    frequent = h.frequent_chunks(h.chunk_table(records).repartition("h").sortWithinPartitions("h"))
    common = {r.h for r in frequent.collect()}
    for r in h.picked_chunks(records, frequent, 0.8).collect():
        assert (r.n, r.need, len(r["keys"])) in ((3, 1, 1), (22, 2, 6)) and not common & set(r["keys"])


def test_a_family_of_near_files_forms_no_pairs(spark, monkeypatch):
    """1,500 mutually near files of different content: each is compared with a few leaders, not with all."""
    base = [f"line {i}" for i in range(30)]
    samples = [(f"p{i}", "\n".join([*base, f"own {i}"])) for i in range(1_500)]
    compared = []
    real = h.confirmed
    monkeypatch.setattr(h, "confirmed", lambda pairs, *a: compared.append(pairs.count()) or real(pairs, *a))
    monkeypatch.setattr(h._accept_in_order, "__defaults__", (10_000, 10_000))
    got = run(spark, [(i, i, None, f"p{i}") for i in range(1_500)], [], samples)
    assert got == {(i, "near") for i in range(1, 1_500)} and sum(compared) <= 1_500 * h.LEADERS * 8
    compared.clear()
    got = run(spark, [(i, i, None, f"p{i}") for i in range(700, 1_500)], [(None, f"p{i}") for i in range(700)], samples)
    assert len(got) == 800 and sum(compared) <= 800 * 12
