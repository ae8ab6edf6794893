"""Arrow batches in slices of bounded bytes, so that a task's memory does not grow with its texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text a slice holds at most, unless one text alone is longer.
SLICE_BYTES = 4_000_000


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Start and length of slices that hold `limit` bytes of text or a single row."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop - start
        start = stop


def by_slices(made: Callable[..., pa.Array], kind: pa.DataType, first: pa.Array, *others: pa.Array) -> pa.Array:
    """`made` of every slice of columns, cut by the bytes of the first one."""
    parts = [made(first.slice(i, n), *[o.slice(i, n) for o in others]).cast(kind) for i, n in slices(first)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
