"""Texts of an Arrow batch as byte arrays: runs of bytes and their 64-bit hashes, without a loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    if len(_powers[0]) < n:
        for k, b in enumerate((BASE, INVERSE)):
            x = np.full(max(n, 1 << 20), b)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values and the offsets between them; no value may be null."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def runs(kinds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of maximal runs of equal non-zero kind inside each document."""
    n = len(kinds)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < n]] = True
    start = np.flatnonzero(edge)
    end = np.append(start[1:], n)
    real = kinds[start] > 0
    start, end = start[real], end[real]
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each run; equal bytes give equal hashes wherever they stand."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def window_hashes(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` following words of one document and the document of each."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, owner.dtype)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * BASE + words[k : k + n]
    same = owner[:n] == owner[size - 1 :]
    return mix(out)[same], owner[:n][same]
