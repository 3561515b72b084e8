"""Shared helpers: reading text tables, cutting lineage, and numpy views of
Arrow string columns.

The numpy helpers work on the UTF-8 bytes of many documents at once: a slice
of an Arrow batch is one byte array plus the documents' start offsets, so no
per-document Python runs in the scans.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quiver.session import materialize

__all__ = ["SLICE_BYTES", "materialize", "read_docs", "slices", "Slice", "mix64", "per_doc_sum", "small_batches"]

#: Bytes of text handled by one numpy step (a longer document is a step of its
#: own): the step's arrays stay in a core's cache.
SLICE_BYTES = 128 << 10

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)  # odd: invertible modulo 2^64
_P_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def read_docs(spark: SparkSession, sf_dir: str, *cols: str, table: str = "documents") -> DataFrame:
    """The table under ``sf_dir`` with only the named columns."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*cols) if cols else df


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift multiply), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


#: A random-looking 64-bit value for each byte value.
BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * _P)

_powers = {"n": 0, "up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _grow(n: int) -> None:
    if _powers["n"] < n:
        n = max(n, 1 << 16)
        for name, base in (("up", _P), ("down", _P_INV)):
            x = np.full(n + 1, base, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x, dtype=np.uint64)
        _powers["n"] = n


class Prefix:
    """Prefix sums of a polynomial hash: the hash of any range of ``values``
    in constant time, equal for equal ranges wherever they stand."""

    def __init__(self, values: np.ndarray):
        _grow(len(values) + 1)
        self.sum = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _powers["up"][:len(values)], dtype=np.uint64, out=self.sum[1:])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        h = (self.sum[hi] - self.sum[lo]) * _powers["down"][lo]
        return mix64(h + (hi - lo).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


class Slice:
    """Consecutive rows of a batch: ``data`` (bytes) and ``start`` (offsets,
    one more than rows). ``rows`` are their positions in the batch."""

    def __init__(self, lo: int, hi: int, data: np.ndarray, start: np.ndarray):
        self.lo, self.hi, self.data, self.start = lo, hi, data, start
        self.n = hi - lo
        self._doc = None

    @property
    def doc(self) -> np.ndarray:
        """Row number (from 0 in the slice) of each byte."""
        if self._doc is None:
            self._doc = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.start))
        return self._doc

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of each word (``[^\\x20\\x09-\\x0D]+``)."""
        ink = ~SPACE[self.data]
        first = ink.copy()
        first[1:] &= ~ink[:-1]
        edge = self.start[:-1][np.diff(self.start) > 0]
        first[edge] = ink[edge]
        last = ink.copy()
        last[:-1] &= ~ink[1:]
        last[edge[1:] - 1] = ink[edge[1:] - 1]
        s = np.flatnonzero(first)
        return s, np.flatnonzero(last) + 1, self.doc[s] if len(s) else np.zeros(0, np.int32)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of each line (split at \\n; empty texts have one)."""
        nl = np.flatnonzero(self.data == 10)
        lo = np.concatenate([self.start[:-1], nl + 1])
        row = np.concatenate([np.arange(self.n, dtype=np.int32), self.doc[nl] if len(nl) else np.zeros(0, np.int32)])
        order = np.lexsort((lo, row))
        lo, row = lo[order], row[order]
        hi = np.empty_like(lo)
        hi[:-1] = lo[1:] - 1
        last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
        hi[last] = self.start[1:][row[last]]
        return lo, hi, row


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64, from 0) of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, off, data = col.buffers()
    off = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into runs of rows of about ``limit`` bytes."""
    data, off = text_bytes(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, min(int(np.searchsorted(off, off[lo] + limit, "right")) - 1, n))
        yield Slice(lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        lo = hi


def per_doc_sum(flags: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive offsets (empty ranges give 0)."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[start[1:]] - total[start[:-1]]


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """Arrow batches of few rows for the jobs run inside: whole texts in the
    default batches would fill executors' memory outside the heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)
