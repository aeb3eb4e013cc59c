"""Helpers for tasks that work on Arrow batches: text as flat bytes, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that a task works on at a time. Memory only: a text is never cut, results do not depend on it.
CHUNK_BYTES = 2 << 20


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, chunk_bytes: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, UTF-8 bytes, offsets) with about ``chunk_bytes`` of text each; a null text is empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets, data = flat_text(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + chunk_bytes, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            lo, hi = offsets[begin], offsets[end]
            yield batch.slice(begin, end - begin), data[lo:hi], offsets[begin : end + 1] - lo
            begin = end


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, from 0) and bytes of a string or binary column; nulls are empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return offsets - offsets[0], np.zeros(0, np.uint8)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for lengths[0] numbers, then the same from starts[1], and so on."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths)


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value per row: the bytes of ``values[offsets[i]:offsets[i + 1]]``."""
    width = values.dtype.itemsize
    ends = np.asarray(offsets, np.int64) * width
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    ).cast(pa.binary())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finisher of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
