"""Text that was decoded with the wrong character encoding: find it and restore it.

A character trigram model with back-off is trained on clean records. Every cluster of
non-ASCII characters is then rewritten by every candidate chain (encode with the
charset it was read as, decode with the one it was written in, up to three times), the
model scores what comes out, and the likeliest is accepted if it beats the text as it
stands by more than a margin. The margin is validated on clean records held out from
training, none of which it may change.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import slices

#: Charsets UTF-8 is commonly read as.
UTF8_READ_AS = ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "cp852", "cp866", "mac_roman", "koi8_r", "iso8859_2", "iso8859_15", "cp1254", "cp1257")
#: (read as, written in) for single-byte charsets.
SINGLE_BYTE = (
    ("cp1252", "cp1251"), ("latin-1", "cp1251"), ("cp1252", "koi8_r"), ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp866", "cp1251"), ("cp1251", "cp866"),
    ("cp1252", "cp866"), ("mac_cyrillic", "cp1251"), ("cp1252", "cp1250"), ("latin-1", "iso8859_2"), ("cp1252", "iso8859_2"), ("cp1250", "cp1252"), ("cp1251", "cp1252"),
    ("cp1251", "cp1250"), ("latin-1", "cp1252"), ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp850", "cp1252"), ("cp437", "cp1252"),
)
REPEATS = 3
BI_BITS, TRI_BITS = 20, 22
CODE_POINTS = 0x110000
#: One in so many records validates the margin, by hash of the text; the model itself counts all clean records but these.
HELD_OUT_SHARE = 10
#: Gains and likelihoods are counted in steps of 1/256, gains up to 256.
STEPS, MOST_STEPS = 256, 1 << 16
LEAST_MARGIN = 4.0
#: Single-byte chains that change fewer characters in a record need a margin of their own: one rare character is weak evidence.
LEAST_CHANGED = 3

#: Non-ASCII characters with at most six printable ASCII ones between; up to three on either side belong to the cluster.
_CORE = re.compile(r"[^\x00-\x7f]+(?:[\x21-\x7e]{1,6}[^\x00-\x7f]+)*")
_CONTEXT = 3
_LOST = re.compile("[�\x80-\x84\x86-\x9f]")
#: A Cyrillic letter beside a Latin one: what a single-byte chain makes of other damage, never a word.
_MIXED = re.compile("[A-Za-z\xc0-\u024f][\u0400-\u04ff]|[\u0400-\u04ff][A-Za-z\xc0-\u024f]")
_INNER_CAPITAL = re.compile("[\u0430-\u045f][\u0400-\u042f]")
_SPACE = re.compile(r"\s+")
_DIGIT = re.compile(r"[1-9]")


def _to_bytes(charset: str) -> dict[str, int]:
    """Character to byte; bytes the charset leaves undefined stand for the control of that number."""
    out: dict[str, int] = {}
    for b in range(0x80, 0x100):
        try:
            ch = bytes([b]).decode(charset)
        except UnicodeDecodeError:
            ch = chr(b)
        out.setdefault(ch, b)
    return out


_BYTES = {c: _to_bytes(c) for c in {*UTF8_READ_AS, *(r for r, _ in SINGLE_BYTE)}}


def _multi_byte(charset: str) -> re.Pattern:
    """Finds what may be one multi-byte UTF-8 character read as this charset: a first byte and its first continuation."""
    at = lambda low, high: "".join(re.escape(ch) for ch, b in _BYTES[charset].items() if low <= b <= high)
    return re.compile(f"[{at(0xC2, 0xF4)}][{at(0x80, 0xBF)}]")


_MULTI_BYTE = {c: _multi_byte(c) for c in UTF8_READ_AS}


def _decode_table(read: str, written: str) -> dict[int, str]:
    out = {}
    for ch, b in _BYTES[read].items():
        try:
            real = bytes([b]).decode(written)
        except UnicodeDecodeError:
            continue
        if real != ch:
            out[ord(ch)] = real
    return out


_SINGLE = {(r, w): _decode_table(r, w) for r, w in SINGLE_BYTE}


def utf8_units(text: str, charset: str) -> list[tuple[int, int, str]]:
    """(start, end, character) wherever the charset's bytes form one multi-byte character."""
    start = _MULTI_BYTE[charset].search(text)
    if start is None:
        return []
    table, out, i, n = _BYTES[charset], [], start.start(), len(text)
    while i < n:
        b = table.get(text[i], 0)
        k = 1 if 0xC2 <= b <= 0xDF else 2 if 0xE0 <= b <= 0xEF else 3 if 0xF0 <= b <= 0xF4 else 0
        if k and i + k < n:
            tail = [table.get(c, 0) for c in text[i + 1 : i + 1 + k]]
            if all(0x80 <= x <= 0xBF for x in tail):
                try:
                    out.append((i, i + k + 1, bytes([b, *tail]).decode()))
                    i += k + 1
                    continue
                except UnicodeDecodeError:
                    pass
        i += 1
    return out


def cluster_spans(text: str) -> list[tuple[int, int]]:
    """Where the clusters of a text lie; they don't overlap."""
    out, done = [], 0
    for m in _CORE.finditer(text):
        a, b = m.span()
        least, most = max(done, a - _CONTEXT), min(len(text), b + _CONTEXT)
        while a > least and "!" <= text[a - 1] <= "~":
            a -= 1
        while b < most and "!" <= text[b] <= "~":
            b += 1
        out.append((a, b))
        done = b
    return out


def clusters(text: str) -> set[str]:
    return {text[a:b] for a, b in cluster_spans(text)}


def _rewrite(text: str, units: list[tuple[int, int, str]]) -> str:
    parts, at = [], 0
    for a, b, ch in units:
        parts += [text[at:a], ch]
        at = b
    return "".join([*parts, text[at:]])


def candidates(text: str, repeats: int = REPEATS) -> Iterator[tuple[str, str]]:
    """(chain, rewritten text) for every chain that changes the text."""
    seen, front = {text}, [("", text)]
    for _ in range(repeats):
        following = []
        for chain, t in front:
            for c in UTF8_READ_AS:
                if units := utf8_units(t, c):
                    new = _rewrite(t, units)
                    if new not in seen:
                        seen.add(new)
                        following.append((f"{chain} {c}>utf-8".strip(), new))
        yield from following
        front = following
    for (read, written), table in _SINGLE.items():
        new = text.translate(table)
        if new not in seen:
            seen.add(new)
            yield f"{read}>{written}", new


#: Name of the chain in which bytes were dropped because their character didn't print.
LOSSY = "dropped controls>utf-8"


def residues(known: set[str]) -> dict[str, tuple[str, ...]]:
    """What remains of known characters whose UTF-8 was read as Latin-1 or cp1252 and stripped of what doesn't print."""
    out: dict[str, set[str]] = {}
    for ch in known:
        raw = ch.encode()
        for left in (re.sub("[\x80-\x9f]", "", raw.decode("latin-1")), raw.decode("cp1252", "ignore")):
            if left and len(left) < len(raw):
                out.setdefault(left, set()).add(ch)
    return {k: tuple(sorted(v)) for k, v in out.items()}


def normal(text: str) -> str:
    """The text as the model sees it: white space as one blank, digits alike."""
    return _DIGIT.sub("0", _SPACE.sub(" ", text))


def _bi(a, b):
    return ((a * 0x9E3779B1) ^ (b * 0x85EBCA77)) >> 7 & ((1 << BI_BITS) - 1)


def _tri(a, b, c):
    return ((a * 0x9E3779B1) ^ (b * 0x85EBCA77) ^ (c * 0xC2B2AE3D)) >> 7 & ((1 << TRI_BITS) - 1)


#: Which code points are white space, as a table.
_BLANK = np.array([chr(i).isspace() for i in range(0x3001)])


def normal_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts as ``normal`` has them, one behind the other; whether each begins a text)."""
    raw = [t.encode("utf-32-le", "surrogatepass") for t in texts if t]
    c = np.frombuffer(b"".join(raw), dtype=np.uint32).copy()
    begins = np.zeros(len(c), dtype=bool)
    if raw:
        begins[np.cumsum([0, *(len(x) // 4 for x in raw[:-1])])] = True
    c[(c >= 0x31) & (c <= 0x39)] = 0x30
    blank = _BLANK[np.minimum(c, 0x3000)] & (c <= 0x3000)
    c[blank] = 0x20
    kept = ~blank | begins
    kept[1:] |= ~blank[:-1]
    return c[kept], begins[kept]


def count_grams(texts: list[str], counts: np.ndarray) -> None:
    """Adds all 1-, 2- and 3-grams to a table: code points first, then bigrams, then trigrams."""
    c, begins = normal_points(texts)
    counts[:CODE_POINTS] += np.bincount(c, minlength=CODE_POINTS)
    # 32 bits suffice: the slots are made of bits 7 to 28 of the products
    a, b, inner = c[:-1], c[1:], ~begins[1:]
    counts[CODE_POINTS : CODE_POINTS + (1 << BI_BITS)] += np.bincount(_bi(a, b)[inner], minlength=1 << BI_BITS)
    counts[CODE_POINTS + (1 << BI_BITS) :] += np.bincount(_tri(a[:-1], b[:-1], c[2:])[inner[:-1] & inner[1:]], minlength=1 << TRI_BITS)


@dataclass(frozen=True)
class Rewriting:
    """The likeliest rewriting of a cluster. ``gain`` is its log likelihood over the cluster's."""

    text: str
    gain: float = 0.0
    chain: str = ""
    changed: int = 0
    per_character: float = 0.0
    #: every single-byte chain that gives this text
    agreeing: tuple[str, ...] = ()
    #: the likelier refilled text that counts where a single-byte chain has little evidence
    instead: Rewriting | None = None

    @property
    def single_byte(self) -> bool:
        return bool(self.chain) and not self.chain.endswith(">utf-8")


def evidence(found: Iterable[Rewriting]) -> dict[str, int]:
    """How many characters of a record each single-byte chain explains, for all chains that give the text.

    Every occurrence counts, but one that refilling explains better only once: it is restored either way.
    """
    out: dict[str, int] = {}
    found = list(found)
    for r in [*(r for r in found if not r.instead), *{r.text: r for r in found if r.instead}.values()]:
        for chain in r.agreeing:
            out[chain] = out.get(chain, 0) + r.changed
    return out


def _short(r: Rewriting, explained: dict[str, int]) -> bool:
    return r.single_byte and max(explained[c] for c in r.agreeing) < LEAST_CHANGED


#: What the models a worker process works with have found so far, by model; tasks of later stages go on with it.
_MEMORIES: dict[str, Memory] = {}


@dataclass
class Memory:
    """Rewritings of clusters, fillings, likelihoods of grams: all follow from counts and residues alone."""

    rewritings: dict[str, tuple[Rewriting, Rewriting | None]] = field(default_factory=dict)
    fills: dict[tuple[str, str], tuple[str, int]] = field(default_factory=dict)
    grams: dict[str, float] = field(default_factory=dict)


def _memory(name: str) -> Memory:
    if name not in _MEMORIES:
        _MEMORIES.clear()  # one model at a time
        _MEMORIES[name] = Memory()
    return _MEMORIES[name]


@dataclass
class Model:
    """Interpolated character trigrams in tables of fixed size (about 27 MB as 32-bit counts).

    ``margin`` is the gain a rewriting needs, ``short_margin`` that of a single-byte chain
    with fewer than ``LEAST_CHANGED`` characters in the record, ``floor`` the likelihood
    per character below which what comes out is no text either.
    """

    counts: np.ndarray
    residues: dict[str, tuple[str, ...]] = field(default_factory=dict)
    margin: float = LEAST_MARGIN
    floor: float = -math.inf
    short_margin: float = LEAST_MARGIN
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __post_init__(self):
        self.total = float(self.counts[:CODE_POINTS].sum()) + 1.0
        self.memory = Memory()

    def __getstate__(self):
        return self.__dict__ | {"memory": None}

    def __setstate__(self, state):
        self.__dict__.update(state, memory=_memory(state["name"]))

    def _likelihood(self, gram: str) -> float:
        """Log likelihood of the last character of one to three."""
        n, c = self.counts, ord(gram[-1])
        p = (float(n[c]) + 0.05) / (self.total + 0.05 * 150_000)
        if len(gram) > 1:
            b = ord(gram[-2])
            pair = float(n[CODE_POINTS + _bi(b, c)])
            p = (pair + 20.0 * p) / (max(float(n[b]), pair) + 20.0)
            if len(gram) > 2:
                a = ord(gram[0])
                before = float(n[CODE_POINTS + _bi(a, b)])
                triple = min(float(n[CODE_POINTS + (1 << BI_BITS) + _tri(a, b, c)]), before)
                p = (triple + 5.0 * p) / (before + 5.0)
        return math.log(p)

    def score(self, text: str, skip: int = 0, least: float = -math.inf) -> float:
        """Log likelihood of the characters of a cluster behind the first ``skip``; no further than to where it isn't above ``least`` any more."""
        t, grams, out = normal(text), self.memory.grams, 0.0
        for at in range(skip, len(t)):
            gram = t[at - 2 if at > 2 else 0 : at + 1]
            p = grams.get(gram)
            if p is None:
                if len(grams) > 500_000:
                    grams.clear()
                p = grams[gram] = self._likelihood(gram)
            out += p
            if out <= least:
                break
        return out

    def best(self, cluster: str) -> Rewriting:
        """The likeliest rewriting; the cluster itself if none gains. No rewriting may add lost or control characters."""
        known = self.memory.rewritings.get(cluster)
        if known is None:
            known = self._likeliest(cluster)
            if len(self.memory.rewritings) > 200_000:
                self.memory.rewritings.clear()
            if len(cluster) <= 200:
                self.memory.rewritings[cluster] = known
        got, refill = known
        if refill and refill.gain <= max(got.gain if not got.single_byte else 0.0, 2 * self.margin):
            refill = None
        if refill and (not got.single_byte or refill.gain > 2 * got.gain):
            return refill
        return replace(got, instead=refill) if got.single_byte else got

    def _likeliest(self, cluster: str) -> tuple[Rewriting, Rewriting | None]:
        """The likeliest result of a chain, or the cluster itself, and the likeliest refilled text."""
        base, got, refill, lost = None, Rewriting(cluster), None, len(_LOST.findall(cluster))
        # what is not printable ASCII stands next to white space where the cluster ends with it
        left, right = " " * (cluster[0] > "~"), " " * (cluster[-1] > "~")
        scored = lambda t, least=-math.inf: self.score(left + t + right, 0, least)
        for chain, new in candidates(cluster):
            if len(_LOST.findall(new)) > lost or "\x85" in new and "\x85" not in cluster:
                continue
            base = scored(cluster) if base is None else base
            s = scored(new, base + got.gain)  # no further than to where it can't win any more
            if s - base > got.gain:
                got = Rewriting(new, s - base, chain, sum(x != y for x, y in zip(cluster, new, strict=False)), s / len(new))
        for new in self._refilled(cluster, left, right):
            base = scored(cluster) if base is None else base
            s = scored(new, base + (refill.gain if refill else 0.0))
            if s - base > (refill.gain if refill else 0.0):
                refill = Rewriting(new, s - base, LOSSY, 1, s / len(new))
        if got.single_byte:
            got = replace(got, agreeing=tuple(f"{r}>{w}" for (r, w), table in _SINGLE.items() if cluster.translate(table) == got.text))
        return got, refill

    def _refilled(self, cluster: str, left: str, right: str) -> Iterator[str]:
        """The cluster with each residue of a character that lost bytes replaced by the likeliest known character that leaves it.

        From left to right, by local scores alone, so that a cluster of any length takes time in its length.
        """
        if not any(r in cluster for r in self.residues):
            return
        for start in {cluster, _rewrite(cluster, utf8_units(cluster, "latin-1")), _rewrite(cluster, utf8_units(cluster, "cp1252"))}:
            done, head, i, n = [], left, 0, len(start)
            while i < n:
                ch, k = start[i], 1
                if any(start[i : i + m] in self.residues for m in (1, 2, 3)):
                    # all that a replacement of up to three characters can change the likelihood of
                    end = i + 5
                    while end < n and len(normal(start[i + 3 : end])) < 2:
                        end += 1
                    ch, k = self._fill(head, start[i:end] + right * (end >= n))
                done.append(ch)
                head, i = normal(head + ch)[-2:], i + k
            if (t := "".join(done)) != start:
                yield t

    def _fill(self, head: str, window: str) -> tuple[str, int]:
        """(likeliest character, characters it replaces) at the start of a window behind ``head``; its first one if nothing is likelier."""
        fills = self.memory.fills
        got = fills.get((head, window))
        if got is None:
            got, best, skip = (window[0], 1), self.score(head + window, len(head)), len(head)
            for k in (1, 2, 3):
                for ch in self.residues.get(window[:k], ()) if k <= len(window) else ():
                    s = self.score(head + ch + window[k:], skip, best)
                    if s > best:
                        got, best = (ch, k), s
            if len(fills) > 500_000:
                fills.clear()
            fills[head, window] = got
        return got

    def repair(self, text: str) -> tuple[str, int, int]:
        """(restored text, clusters restored, characters and clusters that are lost for good)."""
        if text.isascii():
            return text, 0, 0
        spans = cluster_spans(text)
        likely = {c: r for c in {text[a:b] for a, b in spans} if (r := self.best(c)).gain > self.margin}
        if not likely:
            return text, 0, len(_LOST.findall(text))
        explained = evidence(likely[c] for a, b in spans if (c := text[a:b]) in likely)
        parts, at, restored, lost = [], 0, 0, 0
        for a, b in spans:
            r = likely.get(text[a:b])
            if r is not None and _short(r, explained):
                r = r.instead or (r if r.gain > self.short_margin else None)
            if r is None:
                continue
            if r.single_byte and (r.per_character < self.floor or _MIXED.search(r.text)):
                lost += 1
                continue
            parts += [text[at:a], r.text]
            at, restored = b, restored + 1
        fixed = "".join([*parts, text[at:]])
        return fixed, restored, lost + len(_LOST.findall(fixed))


def looks_garbled(text: str, known: set[str]) -> bool:
    """A coarse test that keeps doubtful records out of training.

    True for lost and control characters, for byte sequences that decode to a character
    the corpus uses elsewhere, for runs of four letters that are one script when read
    with another charset, and for Cyrillic words with a capital inside, which confusions
    of two Cyrillic charsets leave.
    """
    if text.isascii():
        return False
    if _LOST.search(text) or _INNER_CAPITAL.search(text):
        return True
    return any(_doubtful(c, known) for c in clusters(text))


def _doubtful(cluster: str, known: set[str]) -> bool:
    if any(ch in known for c in UTF8_READ_AS for _, _, ch in utf8_units(cluster, c)):
        return True
    return any(all(ch in known for ch in run.translate(_SINGLE["cp1252", "cp1251"])) for run in re.findall("[\xa8\xb8\xc0-\xff]{4,}", cluster))


class CleanTest:
    """``looks_garbled`` with a memory for clusters, as few of them make up most of a corpus."""

    def __init__(self, known: set[str]):
        self.known, self.seen = known, {}

    def garbled(self, text: str) -> bool:
        if text.isascii():
            return False
        if _LOST.search(text) or _INNER_CAPITAL.search(text):
            return True
        for c in clusters(text):
            got = self.seen.get(c)
            if got is None:
                got = _doubtful(c, self.known)
                if len(c) <= 200 and len(self.seen) < 500_000:
                    self.seen[c] = got
            if got:
                return True
        return False


def _sum_slots(pieces: DataFrame, size: int) -> np.ndarray:
    """Adds (slot, n) rows; at most one row per slot of a table of fixed size reaches the driver."""
    counts = np.zeros(size, dtype=np.float64)
    got = pieces.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return counts


def _sparse(counts: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at].astype(np.int64))], ["slot", "n"])


def known_characters(texts: DataFrame, text: str) -> set[str]:
    """Non-ASCII characters found in at least two records, by a count over all records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CODE_POINTS, dtype=np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                if t and not t.isascii():
                    at = np.unique(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
                    counts[at] += 1
        yield _sparse(counts)

    n = _sum_slots(texts.select(text).mapInArrow(run, "slot int, n bigint"), CODE_POINTS)
    return {chr(c) for c in np.flatnonzero(n >= 2) if c > 0x9F and c != 0xFFFD}


def train(documents: DataFrame, text: str = "text") -> Model:
    """Counts all clean records of the corpus and validates the margin on held-out clean ones."""
    sc = documents.sparkSession.sparkContext
    rows = documents.select(text).filter(F.col(text).isNotNull() & (F.col(text) != ""))
    known = sc.broadcast(known_characters(rows, text))
    size = CODE_POINTS + (1 << BI_BITS) + (1 << TRI_BITS)
    held = F.pmod(F.xxhash64(text), F.lit(HELD_OUT_SHARE)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, test = np.zeros(size, dtype=np.int64), CleanTest(known.value)
        for b in slices(batches, 0):
            clean = [t for t in b.column(0).to_pylist() if not test.garbled(t)]
            count_grams(clean, counts)
        yield _sparse(counts)

    counts = _sum_slots(rows.filter(~held).mapInArrow(count, "slot int, n bigint"), size)
    model = Model(np.minimum(counts, 2**31 - 1).astype(np.int32), residues(known.value))

    shared = sc.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, m = CleanTest(known.value), shared.value
        for b in slices(batches, 1):
            got = [(h, *measured(m, t)) for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if not t.isascii() and not test.garbled(t)]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], k) for i, k in enumerate(kinds)], ["h", "gain", "single", "each"])

    each = rows.filter(held).select(F.xxhash64(text).alias("h"), text).mapInArrow(measure, "h bigint, gain int, single int, each array<int>").dropDuplicates(["h"])
    kinds = F.concat(F.array(F.struct(F.lit("gain").alias("kind"), F.col("gain").alias("at")), F.struct(F.lit("single").alias("kind"), F.col("single").alias("at"))), F.transform("each", lambda x: F.struct(F.lit("each").alias("kind"), x.alias("at"))))
    bins = each.select(F.explode(kinds).alias("k")).groupBy("k.kind", "k.at").agg(F.count(F.lit(1)).alias("n")).collect()
    model.margin, model.floor, model.short_margin = validated({k: {r["at"]: r.n for r in bins if r.kind == k} for k in ("gain", "single", "each")})
    return model


def measured(model: Model, text: str) -> tuple[int, int, list[int]]:
    """In steps: the largest gain a rewriting has in a record, the largest of a single-byte chain, and the likelihood per character of each cluster."""
    found = [model.best(text[a:b]) for a, b in cluster_spans(text)]
    explained = evidence(found)
    gains = [max((r.gain for r in some), default=0.0) for some in ((r for r in found if not _short(r, explained)), (r for r in found if r.single_byte))]
    return *(min(MOST_STEPS, math.ceil(g * STEPS)) for g in gains), [math.floor(model.score(c) / len(c) * STEPS) for c in clusters(text)]


def _quantile(counted: dict[int, int], share: float) -> float:
    """The value at or below which ``share`` of all counted ones lie, of a histogram in steps."""
    at = sorted(counted)
    ends = np.cumsum([counted[a] for a in at])
    return at[int(np.searchsorted(ends, int(share * (ends[-1] - 1)), side="right"))] / STEPS


def validated(counted: dict[str, dict[int, int]]) -> tuple[float, float, float]:
    """Margin, floor and the margin of short passages from histograms of what ``measured`` gives of all held-out clean records, copies left out.

    The margin is half as much again as the largest gain any rewriting has in all but one
    in 200 of them (a few garbled records may have passed as clean); the floor is the
    likelihood per character that all but one in 200 of their clusters reach. The margin
    of short passages is the same of all gains of single-byte chains, few changes included.
    """
    margin, short = (max(LEAST_MARGIN, 1.5 * _quantile(counted[k], 0.995)) if counted[k] else LEAST_MARGIN for k in ("gain", "single"))
    return margin, _quantile(counted["each"], 0.005) if counted["each"] else -math.inf, max(margin, short)


def repair_corpus(documents: DataFrame, model: Model, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, text, n_restored, n_lost) for every record; null and empty texts stay as they are.

    ``n_restored`` counts clusters that were rewritten, ``n_lost`` replacement and control
    characters that remain and can't be restored. A record is garbled if either is above 0.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, 1):
            got = [(None, 0, 0) if t is None else m.repair(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([g[i] for g in got], k) for i, k in enumerate((pa.string(), pa.int32(), pa.int32())))], [doc, text, "n_restored", "n_lost"])

    return documents.select(doc, text).mapInArrow(run, f"{doc} {documents.schema[doc].dataType.simpleString()}, {text} string, n_restored int, n_lost int")


def garbled_records(documents: DataFrame, model: Model, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_restored, n_lost) of the records ``repair_corpus`` finds garbled; those of ASCII alone never leave the scan."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, 1):
            got = [(k, restored, lost) for k, (_, restored, lost) in enumerate(map(m.repair, b.column(1).to_pylist())) if restored or lost]
            if got:
                at, restored, lost = zip(*got, strict=True)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(restored, pa.int32()), pa.array(lost, pa.int32())], [doc, "n_restored", "n_lost"])

    beyond = documents.filter(F.col(text).rlike(r"[^\x00-\x7f]")).select(doc, text)
    return beyond.mapInArrow(run, f"{doc} {documents.schema[doc].dataType.simpleString()}, n_restored int, n_lost int")
