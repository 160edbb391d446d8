import random

import pytest

from sluice.llm import leakage as lk


def brute(docs, items, n=12):
    grams = {}
    for i, t in items:
        w = lk.words(t or "")
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = set()
    for d, t in docs:
        w = lk.words(t or "")
        for k in range(len(w) - n + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k : k + n]), ())}
    return out


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "x") for d in docs], "doc_id bigint, text string, item_id string"), spark.createDataFrame([(*i, "y") for i in items], "item_id bigint, text string, doc_id string")


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ünï", "42", "don", "日本"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([5, 11, 12, 40])))) for i in range(25)] + [(90, None), (91, "")]
    docs = [(1000, None), (1001, ""), (1002, "  "), (1003, " ".join(items[0][1].split()[:11]))]
    for d in range(120):
        i = 3 if rnd.random() < 0.3 else rnd.randrange(25)
        w = items[i][1].split()
        a = rnd.randrange(len(w))
        part = w[a : a + rnd.randrange(1, 30)]
        joined = "".join(x.upper() + rnd.choice([" ", "\n", ", ", " - ", "_", "…"]) for x in part)
        docs.append((d, "intro words here " + joined + " w1 w2 outro"))
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_loop_over_windows(spark, seed):
    docs, items = corpus(seed)
    d, i = frames(spark, docs, items)
    want = brute(docs, items)
    assert want and {tuple(r) for r in lk.leaks(d, i).collect()} == want
    size = sum(len((t or "").encode()) for _, t in items)
    assert len(list(lk.item_blocks(i, "item_id", "text", 12, size // 3))) > 3
    assert {tuple(r) for r in lk.leaks(d, i, max_item_bytes=size // 3).collect()} == want
    whole = sorted(map(str, lk.without_leaks(d, i).collect()))
    assert sorted(map(str, lk.without_leaks(d, i, max_item_bytes=size // 3).collect())) == whole


def test_items_that_share_a_window_are_all_reported(spark):
    text = " ".join(f"a{i}" for i in range(12))
    d, i = frames(spark, [(1, f"x {text} y"), (2, text[:-1])], [(1, text), (2, f"q {text}"), (3, "other")])
    assert {tuple(r) for r in lk.leaks(d, i).collect()} == {(1, 1), (1, 2)}


def test_empty_tables_and_long_text(spark):
    d, i = frames(spark, [(1, "word " * 200_000)], [(1, "word " * 12)])
    assert lk.leaks(d, i).count() == 1 and lk.leaks(d.limit(0), i).count() == 0 and lk.leaks(d, i.limit(0)).count() == 0


def test_spans_are_removed(spark):
    text = " ".join(f"a{i}" for i in range(14))
    d, i = frames(spark, [(1, f"Before. {text}, after!"), (2, "clean"), (3, None), (4, text)], [(1, text)])
    got = {r.doc_id: (r.text, r.n_leaked_words) for r in lk.without_leaks(d, i).collect()}
    assert got == {1: ("Before. , after!", 14), 2: ("clean", 0), 3: (None, 0), 4: ("", 14)}


def test_blocks_find_what_overlaps_and_repeated_documents_keep_their_texts(spark):
    """Windows of items in different blocks overlap in one document; an id may come with two texts."""
    w = [f"a{i}" for i in range(30)]
    items = [(1, " ".join(w[:14])), (2, " ".join(w[10:26]))]
    docs = [(7, "x " + " ".join(w[:27]) + " y"), (7, "clean"), (7, None), (None, " ".join(w[10:26]))]
    d, i = frames(spark, docs, items)
    for most in (10**6, 60):
        got = sorted(((r.doc_id, r.text, r.n_leaked_words) for r in lk.without_leaks(d, i, max_item_bytes=most).collect()), key=str)
        assert got == [(7, "clean", 0), (7, "x  a26 y", 26), (7, None, 0), (None, "", 16)]
