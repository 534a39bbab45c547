"""Whole Arrow text columns as arrays of word hashes, without a Python object per word.

A word is a run of bytes other than space and 0x09-0x0D (or other than the
bytes of a given table). Its 64-bit hash is a polynomial over the bytes, taken
from prefix sums modulo 2**64, with a final mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95  # odd, so it has an inverse modulo 2**64
_CHUNK = 1 << 16

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: All ASCII bytes except letters and digits; bytes of other scripts belong to words.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit moves every output bit; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP))


def _powers(base: int) -> np.ndarray:
    out = np.full(_CHUNK, base & (2**64 - 1), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, one after the other
    starts: np.ndarray  # of each word in data
    ends: np.ndarray
    docs: np.ndarray  # row of each word
    first: np.ndarray  # of each row: index of its first word; one more entry at the end
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column (null as empty) and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def words(column: pa.Array, separators: np.ndarray = SPACE, lower: bool = False) -> Words:
    data, at = text_bytes(column)
    if lower:
        data = LOWER[data]
    n = len(data)
    gap = separators[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    opens = ~gap
    opens[1:] &= gap[:-1] | edge[1:n]
    closes = ~gap
    closes[:-1] &= gap[1:] | edge[1:n]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(starts, at)
    docs = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(data, starts, ends, docs, first, span_hashes(data, starts, ends))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each data[start:end]. Prefix sums restart every _CHUNK bytes; what spans more than a chunk is added up."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n, parts = len(data), -(-len(data) // _CHUNK)
    sums = np.zeros((parts, _CHUNK + 1), np.uint64)
    for k in range(parts):
        block = BYTE_CODES[data[k * _CHUNK : (k + 1) * _CHUNK]]
        block *= _UP[: len(block)]
        np.cumsum(block, out=sums[k, 1 : len(block) + 1])
        sums[k, len(block) + 1 :] = sums[k, len(block)]
    lengths = (ends - starts).astype(np.uint64)
    a, b = starts // _CHUNK, (ends - 1) // _CHUNK
    value = (sums[a, np.where(a == b, ends - a * _CHUNK, _CHUNK)] - sums[a, starts - a * _CHUNK]) * _DOWN[starts - a * _CHUNK]
    for i in np.flatnonzero(a != b):
        done = (a[i] + 1) * _CHUNK - starts[i]
        for k in range(a[i] + 1, b[i] + 1):
            shift = np.uint64(pow(_BASE, int(done), 2**64))
            value[i : i + 1] += sums[k, min(ends[i] - k * _CHUNK, _CHUNK)] * np.array([shift])
            done += _CHUNK
    return mix(value ^ (lengths * np.uint64(_STEP)))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` hashes; len(hashes) - size + 1 of them (none if there are fewer)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * np.uint64(_BASE) + hashes[j : j + n]
    return mix(out)


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    group = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def crc_fold(key: str, folds: int) -> Column:
    """crc32 of a column's text modulo ``folds``; null for null."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def extended(schema: T.StructType, more: str) -> T.StructType:
    """A schema with the columns of a DDL string after its own."""
    return T.StructType([*schema.fields, *T.StructType.fromDDL(more).fields])
