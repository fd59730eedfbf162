"""Periodic runs of words, found by minimizers at several scales.

A run is a longest stretch of words that repeats with a smallest period q and holds q three
times or more.  Periods up to SHORT are scanned directly, lag by lag.  For longer ones each
scale covers periods from B to T: of the hashes of T consecutive words, those that are least
in some window are kept.  A run is long enough to hold a window and the same window one period
on, whose least hashes lie a period apart, and T words of a run recur in it only at multiples
of q: so the next equal hash is exactly q away.  Such pairs are extended to both sides by
comparing hashes of stretches, doubling as in a search, and every run is checked word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultlens.llm import textops as T
from faultlens.llm.store import pick

TIMES, LEAST = 3, 24  #: periods and words a run holds at least
SHORT = 15  #: longest period that is scanned directly


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(least period, greatest period and words hashed, window) of each scale up to a period."""
    low = SHORT + 1
    while low <= longest:
        high = low + low // 2 - 1
        yield low, high, (TIMES - 1) * low - high + 1
        low = high + 1


def _stretches(flags: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the stretches of at least ``least`` set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    start, end = edge[::2], edge[1::2]
    long = end - start >= least
    return start[long], end[long]


def _sliding(x: np.ndarray, width: int, better) -> np.ndarray:
    """``better`` (minimum or maximum) of every ``width`` neighbours, the first of which names the place."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = better(x[:len(x) - step], x[step:])
        done += step
    return x


def minimizers(g: np.ndarray, window: int) -> np.ndarray:
    """Places whose value is least in some window that holds them."""
    if len(g) < window:
        return np.zeros(0, np.int64)
    low = _sliding(g, window, np.minimum)
    edge = np.zeros(window - 1, g.dtype)
    return np.flatnonzero(_sliding(np.concatenate([edge, low, edge]), window, np.maximum) == g)


class _Stretches:
    """Hashes of any stretch of a sequence, from running sums."""

    def __init__(self, h: np.ndarray):
        n = len(h) + 1
        power, self.inverse = (T._POW, T._IPOW) if n <= len(T._POW) else (T._powers(T._BASE, n), T._powers(T._INV, n))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(h * power[:len(h)], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        return T.mix((self.sums[k:] - self.sums[:-k]) * self.inverse[:len(self.sums) - k])

    def same(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        a = (self.sums[i + n] - self.sums[i]) * self.inverse[i]
        return a == (self.sums[j + n] - self.sums[j]) * self.inverse[j]

    def reach(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How far the stretches at i and j agree, forward or back, at most ``most``."""
        lo, hi = np.zeros_like(most), most.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = self.same(i - mid, j - mid, mid) if back else self.same(i, j, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo


def runs(h: np.ndarray, bounds: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(row, start, length, period) of all runs, by row, start and period.

    ``h`` are word hashes, the words of row i being ``bounds[i]:bounds[i + 1]``.
    """
    n = np.diff(bounds)
    found = []

    def of(rows: np.ndarray):
        """Hashes of some rows one after another, told apart by row, with each word's row and the rows' bounds."""
        size = n[rows]
        ends = np.cumsum(size)
        at = np.arange(int(size.sum())) + np.repeat(bounds[rows] - (ends - size), size)
        row = np.repeat(rows, size)
        return T.mix(h[at] + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), row, np.concatenate([[0], ends])

    def scan(x: np.ndarray, row: np.ndarray, first: np.ndarray, q: int):
        s, e = _stretches(x[:-q] == x[q:], max(least, TIMES * q) - q) if len(x) > q else (np.zeros(0, int),) * 2
        if len(s):
            found.append(np.column_stack([row[s], s - first[s], e - s + q, np.full(len(s), q)]))

    rows = np.flatnonzero(n >= max(least, TIMES))
    if len(rows):
        x, row, edge = of(rows)
        first = np.repeat(edge[:-1], np.diff(edge))
        for q in range(1, SHORT + 1):
            scan(x, row, first, q)
    for low, high, window in scales(int(n.max(initial=0)) // TIMES):
        rows = np.flatnonzero(n >= max(least, TIMES * low))
        x, row, edge = of(rows)
        first, last = np.repeat(edge[:-1], np.diff(edge)), np.repeat(edge[1:], np.diff(edge))
        parts = _Stretches(x)
        g = parts.grams(high)
        inside = row[:len(g)] == row[high - 1:]
        at = minimizers(np.where(inside, g, np.uint64(2**64 - 1)), window)
        at = at[inside[at]]
        at = at[np.argsort(g[at], kind="stable")]
        i, j = at[:-1], at[1:]
        pair = (g[i] == g[j]) & (j - i >= low) & (j - i <= high)
        i, j = i[pair], j[pair]
        if not len(i):
            continue
        s = i - parts.reach(i, j, i - first[i], True)
        e = j + parts.reach(i, j, last[j] - j, False)
        q = j - i
        good = e - s >= np.maximum(least, TIMES * q)
        for a, z, p in np.unique(np.column_stack([s, e, q])[good], axis=0).tolist():
            whole = np.array_equal(x[a:z - p], x[a + p:z]) and (a == first[a] or x[a - 1] != x[a - 1 + p]) and (z == last[a] or x[z] != x[z - p])
            if whole:
                found.append(np.array([[row[a], a - first[a], z - a, p]]))
            else:  # two stretches of one hash: this period word by word
                lo, hi = int(first[a]), int(last[a])
                scan(x[lo:hi], row[lo:hi], np.zeros(hi - lo, int), p)
    if not found:
        return np.zeros((0, 4), np.int64)
    every = np.unique(np.concatenate(found).astype(np.int64), axis=0)  # by row, start, length, period
    same = np.concatenate([[False], (every[1:, :3] == every[:-1, :3]).all(axis=1)])  # multiples of the smallest period
    every = every[~same]
    return every[np.lexsort([every[:, 3], every[:, 1], every[:, 0]])]


def collapsed(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    """The words of a text, one space between, without those that a run holds after its first period."""
    words = text.split()
    if spans:
        stay = np.ones(len(words), bool)
        for start, length, period in spans:
            stay[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(stay).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row.

    Words are what lies between ASCII white space.  ``runs`` are (start, length, period) in
    words from 0, by start and period, each at least ``least`` words and three periods long;
    ``collapsed`` is the text with one period left of each.  A null text counts like an empty one: no words, no
    runs, an empty ``collapsed``.  Rows stand for themselves, whatever their doc_id.
    """
    span = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        T.hold()
        for batch in batches:
            for lo, hi, raw, offsets in T.slices(batch.column(1)):
                w = T.words(raw, offsets, T.SPACED, T.EXACT)
                got = runs(w.hash, w.bounds, least)
                edges = np.searchsorted(got[:, 0], np.arange(hi - lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays([pa.array(got[:, c]) for c in (1, 2, 3)], fields=list(span)))
                data = raw.data
                texts = [collapsed(bytes(data[offsets[k]:offsets[k + 1]]), got[edges[k]:edges[k + 1], 1:].tolist()).decode() for k in range(hi - lo)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(w.bounds).astype(np.int64)), lists, pa.array(texts, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
