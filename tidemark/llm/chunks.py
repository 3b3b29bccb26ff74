"""Arrow batches of texts as numpy bytes, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the n + 1 offsets between them. A null text is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    _, offsets, data = column.buffers()
    size = len(column)
    kind = np.int64 if wide else np.int32
    if not size:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind, size + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return everything[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text; a longer text is a piece of its own."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end
