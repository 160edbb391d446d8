"""Token ids of a whole corpus with a public byte-level BPE vocabulary.

Forced-boundary splitting: a pair of bytes that occurs inside no token of the
vocabulary can never be merged across, so a text may be cut there and the fragments
encoded apart. The words of the vocabulary's splitting pattern must survive the cut as
well; they do where a white-space byte follows a character that is no white space, as
no alternative of the pattern continues over that place and none looks back. Cuts that
satisfy both are certain, and the ids of the fragments, concatenated, are those of the
text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sluice.llm.batches import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public splitting pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Last bytes of the UTF-8 forms of white space beyond ASCII; a character ending so is taken as white space.
_SPACE_TAILS = (0x80, 0x81, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF)
_ASCII_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
#: Ids are remembered for so many fragments of at most so many bytes (some tens of MB).
REMEMBERED, REMEMBERED_BYTES = 200_000, 32


def load_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def inner_pairs(ranks: dict[bytes, int]) -> np.ndarray:
    """256 x 256: whether a byte pair occurs inside any token."""
    seen = np.zeros((256, 256), dtype=bool)
    for token in ranks:
        if len(token) > 1:
            b = np.frombuffer(token, dtype=np.uint8)
            seen[b[:-1], b[1:]] = True
    return seen


def certain_cuts(ranks: dict[bytes, int]) -> np.ndarray:
    """256 x 256: whether a text may be cut between these two bytes."""
    before = np.ones(256, dtype=bool)
    before[list(_ASCII_SPACE) + [0x1C, 0x1D, 0x1E, 0x1F] + list(_SPACE_TAILS)] = False
    after = np.zeros(256, dtype=bool)
    after[list(_ASCII_SPACE)] = True
    return ~inner_pairs(ranks) & before[:, None] & after[None, :]


class Encoder:
    """Encodes texts fragment by fragment, with a memory of short fragments; fragments have at least ``fragment_bytes`` where cuts allow it."""

    def __init__(self, data: bytes, pattern: str = PATTERN, fragment_bytes: int = 1):
        import tiktoken

        self.ranks = load_ranks(data)
        self.cuts = certain_cuts(self.ranks)
        self.fragment_bytes = fragment_bytes
        self.memory: dict[bytes, list[int]] = {}
        self._encode = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary

    def _pieces(self, text: str) -> list[bytes]:
        raw = text.encode()
        b = np.frombuffer(raw, dtype=np.uint8)
        out, at = [], 0
        for i in (np.flatnonzero(self.cuts[b[:-1], b[1:]]) + 1).tolist():
            if i - at >= self.fragment_bytes:
                out.append(raw[at:i])
                at = i
        return [*out, raw[at:]]

    def fragments(self, text: str) -> list[str]:
        return [p.decode() for p in self._pieces(text)]

    def encode(self, text: str | None) -> np.ndarray:
        ids: list[int] = []
        for p in self._pieces(text) if text else ():
            got = self.memory.get(p)
            if got is None:
                got = self._encode(p.decode())
                if len(p) <= REMEMBERED_BYTES and len(self.memory) < REMEMBERED:
                    self.memory[p] = got
            ids += got
        return np.array(ids, dtype=np.int32)


_encoders: dict[tuple, Encoder] = {}


def encode_corpus(documents: DataFrame, doc: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN, fragment_bytes: int = 1) -> DataFrame:
    """(doc, ids): the token ids of every text, without special tokens; empty for empty and for null text.

    Strings that name special tokens are ordinary text. One pass without shuffle. The
    vocabulary (under 1 MB) is read by the driver and broadcast, so executors need no file.
    """
    with open(vocabulary, "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (hash(shared.value), pattern, fragment_bytes)
        if key not in _encoders:
            _encoders[key] = Encoder(shared.value, pattern, fragment_bytes)
        encoder = _encoders[key]
        for part in slices(batches, 1):
            ids = [encoder.encode(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], [doc, "ids"])

    return documents.select(doc, text).mapInArrow(run, f"{doc} {documents.schema[doc].dataType.simpleString()}, ids array<int>")
