"""A batch of texts as one byte buffer, and vectorised span hashing over it."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; numpy needs some 60 times as much for a moment.
CHUNK = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=_U)) | _U(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (splitmix): every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            t = np.full(size, base, dtype=_U)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers = (tables[0], tables[1])
    return _powers


BYTE_VALUES = _byte_values()


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash of the buffer, one entry more than bytes."""
    power, _ = _power_tables(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(BYTE_VALUES[data] * power[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes wherever they stand."""
    _, inverse = _power_tables(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(_U))


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their len + 1 offsets; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds at most ``limit`` bytes of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = buffer(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + limit, side="right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end
    release()


def release() -> None:
    """Give freed memory back: Spark keeps a task's Python worker for later tasks, idle or not."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def ragged(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for every count c, one after another."""
    total = int(counts.sum())
    out = np.arange(total, dtype=np.int64)
    return out - np.repeat(np.cumsum(counts) - counts, counts)


def binary(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column from a buffer and offsets."""
    body = data if isinstance(data, bytes) else np.ascontiguousarray(data).tobytes()
    if offsets[-1] < (1 << 31):
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(body)]
        )
    raise ValueError("a batch of over 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
