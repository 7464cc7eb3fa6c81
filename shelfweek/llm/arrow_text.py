"""Text columns as Arrow hands them to a task: bounded slices and their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time. A single longer text is worked on whole.
SLICE_BYTES = 4 << 20


def text_slices(
    batch: pa.RecordBatch, column: int, at_once: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Runs of rows with at most ``at_once`` bytes of text, or one row; null texts as empty."""
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(texts):
        before = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, before + at_once, "right")))
        yield batch.slice(row, stop - row), texts.slice(row, stop - row)
        row = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, memoryview]:
    """Offsets (from 0) and the bytes of a large_string array without nulls."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = memoryview(data or b"")[offsets[0] : offsets[-1]] if len(texts) else memoryview(b"")
    return offsets - (offsets[0] if len(offsets) else 0), data


def from_raw(offsets: np.ndarray, data: bytes) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs values[start : start + length], one after another."""
    shift = starts - (np.cumsum(lengths) - lengths)
    return values[np.repeat(shift, lengths) + np.arange(lengths.sum())]
