"""Vectorised word and window hashes over the bytes of Arrow text columns.

Everything here works on one slice of a task's rows and is bounded by the slice.
A word is a maximal run of bytes that are not separators. Hashes are polynomials
modulo 2**64 over random byte values, finished by a mixing step; two seeds give
128 bits where a decision rests on equality alone.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
SLICE_BYTES = 4 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing step of splitmix64, a bijection of 64-bit numbers."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _odd(seed: int, salt: int) -> int:
    return int(mix(np.array([seed * 1000003 + salt + 1], U64))[0]) | 1


@lru_cache(maxsize=8)
def _powers(seed: int, salt: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**i and r**-i modulo 2**64 for i < n."""
    r = _odd(seed, salt)
    inverse = pow(r, -1, 1 << 64)
    up, down = np.full(n, r, U64), np.full(n, inverse, U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


@lru_cache(maxsize=8)
def _byte_values(seed: int, lower: bool) -> np.ndarray:
    values = mix(np.arange(256, dtype=U64) + U64(seed * 4096 + 77))
    if lower:
        values[65:91] = values[97:123]
    return values


@lru_cache(maxsize=4)
def _separators(kind: str) -> np.ndarray:
    table = np.zeros(256, bool)
    if kind == "space":  # U+0020 and U+0009 to U+000D
        table[[32, 9, 10, 11, 12, 13]] = True
    else:
        raise ValueError(kind)
    return table


@lru_cache(maxsize=1)
def _trim():
    """The C library's way to return freed memory, if it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


def give_back() -> None:
    """Return what this process has freed to the system: workers serve many stages, and wait between them."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``limit`` text bytes; a longer text comes alone."""
    text = batch.column(column)
    ends = np.frombuffer(text.buffers()[1], _offset_type(text))[text.offset : text.offset + len(text) + 1]
    lo = 0
    while lo < len(text):
        hi = int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), len(text))
        yield batch.slice(lo, hi - lo)
        lo = hi
    pa.default_memory_pool().release_unused()  # workers serve many stages


def _offset_type(text: pa.Array):
    return np.int64 if pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type) else np.int32


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts and ends in them; null is empty."""
    if text.null_count:
        text = text.fill_null("")
    if len(text) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(text.buffers()[1], _offset_type(text))[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


class Words:
    """Words of some rows: ``start`` and ``end`` in the bytes, and ``first[i]`` the first word of row i."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray, kind: str = "space"):
        self.raw = raw
        table, starts, stops = _separators(kind), [], []
        rows = np.unique(ends[(ends > 0) & (ends < len(raw))])
        for lo in range(0, len(raw), CHUNK):
            hi = min(lo + CHUNK, len(raw))
            inside = np.zeros(hi - lo + 2, bool)
            inside[1:-1] = ~table[raw[lo:hi]]
            inside[0] = lo > 0 and not table[raw[lo - 1]]
            inside[-1] = hi < len(raw) and not table[raw[hi]]
            cut = rows[np.searchsorted(rows, lo) : np.searchsorted(rows, hi, side="right")] - lo
            begins = inside[1:-1] & ~inside[:-2]
            begins[cut[cut < hi - lo]] |= inside[1:-1][cut[cut < hi - lo]]
            stop = inside[1:-1] & ~inside[2:]
            before = cut[cut > 0] - 1
            stop[before] |= inside[1:-1][before]
            starts.append(np.flatnonzero(begins) + lo)
            stops.append(np.flatnonzero(stop) + lo + 1)
        self.start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.end = np.concatenate(stops) if stops else np.zeros(0, np.int64)
        self.first = np.searchsorted(self.start, ends, side="left")

    def __len__(self) -> int:
        return len(self.start)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, seed: int, lower: bool = False) -> np.ndarray:
        out = np.empty(len(self), U64)
        values = _byte_values(seed, lower)
        at = 0
        while at < len(self):
            base = self.start[at]
            to = max(int(np.searchsorted(self.end, base + CHUNK, side="right")), at + 1)
            size = int(self.end[to - 1] - base)
            up, down = _powers(seed, 1, CHUNK) if size <= CHUNK else _powers.__wrapped__(seed, 1, size)
            total = np.zeros(size + 1, U64)
            np.cumsum(values[self.raw[base : base + size]] * up[:size], out=total[1:])
            s, e = self.start[at:to] - base, self.end[at:to] - base
            out[at:to] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U64) * U64(_odd(seed, 2)))
            at = to
        return out

    def window_starts(self, length: int) -> np.ndarray:
        """True for each word from which ``length`` words of its row follow, itself included."""
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self))
        return left >= length


def window_hashes(words: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Hash of ``words[i:i+length]`` for each i; the last ones are of no use."""
    n = len(words) - length + 1
    out = np.zeros(len(words), U64)
    if n <= 0:
        return out
    step = 1 << 18
    up, down = _powers(seed, 3, step + length)
    for lo in range(0, n, step):
        part = words[lo : lo + step + length - 1]
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(part * up[: len(part)], out=total[1:])
        m = len(part) - length + 1
        out[lo : lo + m] = mix((total[length : length + m] - total[:m]) * down[:m])
    return out


def pack64(values: np.ndarray) -> bytes:
    """Bytes of 64- or 32-bit numbers, most significant bytes together, which shuffles compress."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes()


def unpack(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()
