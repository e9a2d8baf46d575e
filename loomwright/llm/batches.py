"""Arrow batch plumbing: bounded slices of texts, list columns from numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ..session import spread  # noqa: F401  (shared by the operators here)

#: Code points that are worked on at once; numpy needs some 60 bytes for each.
SLICE_CHARS = 1 << 20


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[slice, list[str]]]:
    """Consecutive row ranges of the batch with at most SLICE_CHARS code points (or one row); null texts as ''."""
    texts = batch.column(column).to_pylist()
    at, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > at and total + n > SLICE_CHARS:
            yield slice(at, i), [x or "" for x in texts[at:i]]
            at, total = i, 0
        total += n
    if at < len(texts):
        yield slice(at, len(texts)), [x or "" for x in texts[at:]]


def lists(values: np.ndarray) -> pa.ListArray:
    """A two-dimensional array as a list column."""
    n, k = values.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * k, pa.array(values.ravel()))
