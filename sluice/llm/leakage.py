"""Evaluation passages inside training text.

Every run of ``n`` words of the evaluation items is hashed over word numbers from the
items' own vocabulary. Documents are turned into the same numbers (words no item has
are 0), their windows are hashed with array operations, looked up in the sorted hash
set, and each hit is verified word by word. A set is broadcast only up to
``max_item_bytes``; more items are taken in blocks of that size, one scan of the documents
each, so the documents are never shuffled and results are the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import slices
from sluice.session import cut, lookup_join

WORD = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    """Runs of letters or digits in lower case; case, punctuation, spacing and line breaks don't count."""
    return WORD.findall(text.lower())


@dataclass
class GramSet:
    """The items as word numbers, and the sorted hashes of their windows with where each occurs."""

    n: int
    vocabulary: dict[str, int]
    items: list[tuple[int, np.ndarray]]
    hashes: np.ndarray
    starts: np.ndarray
    where_item: np.ndarray
    where_pos: np.ndarray


def _windows(ids: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` numbers."""
    m = len(ids) - n + 1
    h = np.zeros(max(m, 0), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n if m > 0 else 0):
            h = h * _MULTIPLIER + ids[j : j + m].astype(np.uint64) + np.uint64(1)
            h ^= h >> np.uint64(29)
    return h


def build(items: list[tuple[int, str]], n: int = 12) -> GramSet:
    vocabulary: dict[str, int] = {}
    coded = []
    for item, text in items:
        if item is None or text is None:
            continue
        coded.append((item, np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)], dtype=np.int64)))
    h = [_windows(ids, n) for _, ids in coded]
    flat = np.concatenate(h) if h else np.zeros(0, dtype=np.uint64)
    who = np.concatenate([np.full(len(x), i) for i, x in enumerate(h)]) if h else np.zeros(0, dtype=np.int64)
    pos = np.concatenate([np.arange(len(x)) for x in h]) if h else np.zeros(0, dtype=np.int64)
    order = np.argsort(flat, kind="stable")
    unique, starts = np.unique(flat[order], return_index=True)
    return GramSet(n, vocabulary, coded, unique, np.append(starts, len(flat)), who[order].astype(np.int64), pos[order].astype(np.int64))


def hits(grams: GramSet, texts: list[str | None]) -> list[tuple[int, int, int]]:
    """Verified (text number, word position, item number) of every window found in an item."""
    get, n = grams.vocabulary.get, grams.n
    parts, owner = [], []
    for k, text in enumerate(texts):
        if text:
            ids = [get(w, 0) for w in words(text)]
            if len(ids) >= n:
                parts.append(np.array([*ids, 0], dtype=np.int64))
                owner.append(k)
    if not parts or not len(grams.hashes):
        return []
    flat = np.concatenate(parts)
    first = np.cumsum([0, *map(len, parts)])
    known = np.concatenate([[0], np.cumsum(flat != 0)])
    m = len(flat) - n + 1
    full = np.flatnonzero(known[n : n + m] - known[:m] == n)
    if not full.size:
        return []
    h = _windows(flat, n)[full]
    slot = np.minimum(np.searchsorted(grams.hashes, h), len(grams.hashes) - 1)
    found = grams.hashes[slot] == h
    out = []
    for at, s in zip(full[found].tolist(), slot[found].tolist(), strict=True):
        doc = int(np.searchsorted(first, at, side="right")) - 1
        window = flat[at : at + n]
        for e in range(grams.starts[s], grams.starts[s + 1]):
            i, p = int(grams.where_item[e]), int(grams.where_pos[e])
            if np.array_equal(grams.items[i][1][p : p + n], window):
                out.append((owner[doc], at - int(first[doc]), i))
    return out


def item_blocks(items: DataFrame, item: str, text: str, n: int, max_item_bytes: int) -> Iterator[GramSet]:
    """The items as gram sets of at most about ``max_item_bytes`` of text each: one set if all fit, else by hash of the id.

    An item stays whole, so one longer than that makes a larger set.
    """
    rows = items.select(F.col(item).alias("item"), F.col(text).alias("text")).filter(F.col("item").isNotNull() & F.col("text").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = 1 if size <= max_item_bytes else -(-2 * size // max(1, max_item_bytes))
    for k in range(blocks):
        block = rows if blocks == 1 else rows.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        yield build([(r.item, r.text) for r in block.collect()], n)


def leaks(documents: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text", n: int = 12, max_item_bytes: int = 32 << 20) -> DataFrame:
    """Distinct (doc, item) where the document holds at least ``n`` consecutive words of the item.

    Null, empty and short texts leak nothing; items shorter than ``n`` words are never
    leaked. All items that share a leaked window are reported. A document id that occurs
    in several rows is reported once.
    """
    out_schema = f"{doc} {documents.schema[doc].dataType.simpleString()}, {item} {items.schema[item].dataType.simpleString()}"

    def scan_with(shared):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams = shared.value
            for b in slices(batches, 1):
                pairs = sorted({(k, i) for k, _, i in hits(grams, b.column(1).to_pylist())})
                if pairs:
                    at = pa.array([k for k, _ in pairs], pa.int64())
                    yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array([grams.items[i][0] for _, i in pairs])], [doc, item])

        return documents.select(doc, text).mapInArrow(scan, out_schema)

    sc = documents.sparkSession.sparkContext
    found = [scan_with(sc.broadcast(grams)) for grams in item_blocks(items, item, text, n, max_item_bytes)]
    return reduce(DataFrame.unionByName, found).distinct()


def leaked_words(documents: DataFrame, items: DataFrame, doc: str, item: str, text: str, n: int, max_item_bytes: int) -> DataFrame:
    """(doc, same, words): for each document with leaks, known by id and hash of its text, the sorted numbers of its leaked words."""

    def scan_with(shared):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams = shared.value
            for b in slices(batches, 2):
                gone: dict[int, set[int]] = {}
                for k, at, _ in hits(grams, b.column(2).to_pylist()):
                    gone.setdefault(k, set()).update(range(at, at + grams.n))
                if gone:
                    rows = pa.array(list(gone))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array([sorted(x) for x in gone.values()], pa.list_(pa.int32()))], [doc, "same", "words"])

        return documents.select(doc, F.xxhash64(text).alias("same"), text).mapInArrow(scan, f"{doc} {documents.schema[doc].dataType.simpleString()}, same bigint, words array<int>")

    sc = documents.sparkSession.sparkContext
    found = reduce(DataFrame.unionByName, [scan_with(sc.broadcast(grams)) for grams in item_blocks(items, item, text, n, max_item_bytes)])
    return found.groupBy(doc, "same").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("words")))).alias("words"))


def without_leaks(documents: DataFrame, items: DataFrame, doc: str = "doc_id", item: str = "item_id", text: str = "text", n: int = 12, max_item_bytes: int = 32 << 20) -> DataFrame:
    """(doc, text, n_leaked_words): texts without the words of every leaked window and what stands between them.

    All windows are found in the text as it is, whatever number of blocks the items take,
    then cut at once. Null texts stay null.
    """
    leaked = cut(leaked_words(documents, items, doc, item, text, n, max_item_bytes))
    joined = lookup_join(documents.select(doc, text).withColumn("same", F.xxhash64(text)), leaked, [doc, "same"]).select(doc, text, "words")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            gone = b.column(2).to_pylist()
            texts = [_cut_words(t, set(w)) if w else t for t, w in zip(b.column(1).to_pylist(), gone, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array([len(w or ()) for w in gone], pa.int32())], [doc, text, "n_leaked_words"])

    return joined.mapInArrow(clean, f"{doc} {documents.schema[doc].dataType.simpleString()}, {text} string, n_leaked_words int")


def _cut_words(text: str, drop: set[int]) -> str:
    at, kept, start = 0, [], None
    spans = [m.span() for m in WORD.finditer(text)]
    for i, (a, b) in enumerate(spans):
        if i in drop and start is None:
            start = a
        if start is not None and (i not in drop or i == len(spans) - 1):
            end = b if i in drop else spans[i - 1][1]
            kept.append(text[at:start])
            at, start = end, None
    return "".join([*kept, text[at:]])
