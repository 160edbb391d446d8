"""Arrow batches cut so that what a task holds at once is bounded, however long the texts are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters of text worked on at once; a longer text is worked on alone.
MOST_CHARACTERS = 2_000_000


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = MOST_CHARACTERS) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in order, in slices whose texts (in ``column``) have at most ``most`` characters together, or one row."""
    for b in batches:
        sizes = pc.fill_null(pc.utf8_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes), 0
        while at < b.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield b.slice(at, to - at)
            at = to
