"""Bounded memory in Python workers: small slices of batches, and freed memory given back."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows, and bytes of text, that are worked on together.
ROWS, SLICE = 1000, 6_000_000


def by_rows(batches: Iterator[pa.RecordBatch], rows: int = ROWS, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows and about ``most`` bytes of text; a longer text is a slice of its own."""
    for b in batches:
        size = np.zeros(b.num_rows, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_large_string(c.type):
                size += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        size, at = np.cumsum(size), 0
        while at < b.num_rows:
            to = max(at + 1, min(at + rows, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right"))))
            yield b.slice(at, to - at)
            at = to


def slices(batch: pa.RecordBatch, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of about ``most`` bytes of its column ``text``."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def tidy() -> None:
    """Gives freed memory back to the system: workers live on and would keep their peaks through all later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, tidying up after its last batch."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        tidy()

    return wrapped
