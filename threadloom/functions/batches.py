"""Arrow batches in parts of bounded size, so that what a task holds does not grow with its batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def parts_of(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(start, length) of neighbouring rows whose sizes add up to `most` or less; a larger row is a part by itself."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop - start
        start = stop


def joined(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
