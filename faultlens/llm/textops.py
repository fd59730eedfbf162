"""Words of whole texts as 64-bit hashes, computed on Arrow buffers without a Python loop per word.

A word's hash is a polynomial of its bytes modulo 2**64 from running sums, mixed afterwards.
Texts are walked in bounded stretches that end between words, so very long texts need no
more memory than short ones.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

STRETCH = 1 << 18  #: bytes hashed at once
SLICE = 1 << 20  #: bytes of text handed on at once
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
EXACT = np.arange(256, dtype=np.uint8)


def table(separators) -> np.ndarray:
    """True for every byte that belongs to a word."""
    out = np.ones(256, dtype=bool)
    out[list(separators)] = False
    return out


SPACED = table([0x20, *range(0x09, 0x0E)])
ALNUM = table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW, _IPOW = _powers(_BASE, STRETCH * 2), _powers(_INV, STRETCH * 2)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


_HELD: dict = {}


def trim() -> None:
    """Give back to the system what earlier tasks of this worker process have freed."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc keeps freed memory otherwise
        libc.malloc_trim(0)


def hold(key: str | None = None, make=None):
    """An object that the tasks of a worker process share; a process holds one at a time.

    Without a key the last one is let go, as tasks that need none do.
    """
    if key not in _HELD:
        _HELD.clear()
        trim()
        if key is None:
            return None
        _HELD[key] = make()
    return _HELD[key]


@dataclass
class Words:
    """Words of some rows, in order: hash, row, first byte and byte past the end (within the row)."""

    hash: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  #: words of row i are bounds[i]:bounds[i + 1]


def _stretch(raw, lo, hi, cuts, is_word, fold):
    b = raw[lo:hi]
    w = is_word[b]
    prev = np.empty_like(w)
    prev[0] = False
    prev[1:] = w[:-1]
    inner = cuts[(cuts > lo) & (cuts < hi)] - lo
    prev[inner] = False
    starts = np.flatnonzero(w & ~prev)
    nxt = np.empty_like(w)
    nxt[-1] = False
    nxt[:-1] = w[1:]
    nxt[inner - 1] = False
    ends = np.flatnonzero(w & ~nxt) + 1
    n = hi - lo
    power, inverse = (_POW, _IPOW) if n <= len(_POW) else (_powers(_BASE, n), _powers(_INV, n))
    run = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((fold[b].astype(np.uint64) + np.uint64(1)) * power[:n], out=run[1:])
    h = (run[ends] - run[starts]) * inverse[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(48))), starts + lo, ends + lo


def words(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray, fold: np.ndarray = LOWER) -> Words:
    """All words of some rows; ``fold`` maps bytes before they are hashed."""
    lo, last = int(offsets[0]), int(offsets[-1])
    cuts = offsets[1:-1]
    parts = []
    while lo < last:
        hi = min(lo + STRETCH, last)
        while hi < last:  # move on to a byte outside words or to a row's end
            ahead = is_word[raw[hi:hi + 4096]]
            edge = np.searchsorted(offsets, hi)
            stop = int(offsets[edge]) - hi
            gap = np.flatnonzero(~ahead)
            step = min(stop, int(gap[0]) if len(gap) else len(ahead))
            hi += step
            if stop == step or len(gap):
                break
        parts.append(_stretch(raw, lo, hi, cuts, is_word, fold))
        lo = hi
    if parts:
        h, s, e = (np.concatenate(x) for x in zip(*parts))
    else:
        h, s, e = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    bounds = np.searchsorted(s, offsets, side="left")
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    base = offsets[row] if len(row) else np.zeros(0, np.int64)
    return Words(h, row, s - base, e - base, bounds)


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row past the end, bytes, offsets) of consecutive rows with about SLICE bytes."""
    raw, offsets = buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + SLICE, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw, offsets[lo:hi + 1]
        lo = hi


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words; the caller masks those that cross rows."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    size = len(h) - n + 1
    out = np.full(size, n, dtype=np.uint64)
    for k in range(n):
        out *= np.uint64(_BASE)
        out += h[k:k + size]
    return mix(out)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
