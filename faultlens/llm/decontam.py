"""Benchmark decontamination by pigeonhole edit matching on words.

A test item of n words may differ by e word edits.  It is cut into e + 1 pieces; a stretch
within e edits holds one of them unchanged, so exact piece hits find every such stretch.
Hits are verified with the bit-parallel edit distance over the words around them.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from faultlens.llm import textops as T
from faultlens.llm.editdist import best_stretch
from faultlens.llm.store import pick

RATE, LEAST_WORDS, LEAST_PIECE = 0.15, 5, 4
BLOCK_CHARS = 8_000_000  #: benchmark text that is sent to the executors at once
BITS = 20


def budget(n: int, rate: float = RATE) -> int:
    return max(0, min(int(rate * n), n // LEAST_PIECE - 1))


def _hashes(column) -> T.Words:
    raw, offsets = T.buffers(pc.utf8_lower(column))
    return T.words(raw, offsets, T.ALNUM)


class Pieces:
    """Piece hashes of some test items, by piece length."""

    def __init__(self, items: list[tuple], rate: float):
        self.items, found = [], defaultdict(lambda: defaultdict(list))
        w = _hashes(pa.array([t for _, t in items], pa.large_string()))
        for i, (item, _) in enumerate(items):
            h = w.hash[w.bounds[i]:w.bounds[i + 1]]
            n = len(h)
            if n < LEAST_WORDS:
                continue
            e = budget(n, rate)
            size = n // (e + 1)
            k = len(self.items)
            self.items.append((item, h.tolist(), e))
            for p in range(e + 1):
                at = p * n // (e + 1)
                found[size][int(T.ngrams(h[at:at + size], size)[0])].append((k, at))
        self.by_size = {}
        for size, table in found.items():
            keys = np.array(sorted(table), np.uint64)
            seen = np.zeros(1 << BITS, bool)
            seen[(keys >> np.uint64(64 - BITS)).astype(np.int64)] = True
            self.by_size[size] = (seen, keys, [table[int(x)] for x in keys])

    def hits(self, w: T.Words):
        """(row, item number, first word the item would have there) of every piece hit."""
        for size, (seen, keys, places) in self.by_size.items():
            g = T.ngrams(w.hash, size)
            at = np.flatnonzero(seen[(g >> np.uint64(64 - BITS)).astype(np.int64)])
            at = at[w.row[at] == w.row[at + size - 1]]
            k = np.minimum(np.searchsorted(keys, g[at]), len(keys) - 1)
            ok = keys[k] == g[at]
            for pos, j in zip(at[ok].tolist(), k[ok].tolist()):
                for item, off in places[j]:
                    yield int(w.row[pos]), item, pos - off

    def matches(self, column):
        """(row, item_id, distance, first word, last word): the best stretch of each row and item."""
        for lo, hi, raw, offsets in T.slices(pc.utf8_lower(column)):
            w = T.words(raw, offsets, T.ALNUM)
            best: dict = {}
            for row, item, at in sorted(set(self.hits(w))):
                name, pattern, e = self.items[item]
                a, z = int(w.bounds[row]), int(w.bounds[row + 1])
                first = max(a, at - e)
                d, s, t = best_stretch(pattern, w.hash[first:min(z, at + len(pattern) + e)].tolist())
                if d <= e:
                    found = (d, first + s - a, first + t - a)
                    best[row, item] = min(best.get((row, item), found), found)
            for (row, item), (d, s, t) in sorted(best.items()):
                yield lo + row, self.items[item][0], d, s, t


def _blocks(items: DataFrame, rate: float):
    """The test items in blocks of bounded size, whatever the size of their table."""
    named = pick(items, "item_id", "text").where("item_id is not null and text is not null")
    chars = named.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for k in range(n):
        rows = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield Pieces([(r[0], r[1]) for r in rows], rate)


def find_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, first_word, last_word): test items found in documents, one row per row and item.

    An item of n words counts as found if a stretch of the document is within
    min(rate * n, n / 4 - 1) word edits of it; words are runs of letters and digits, lower
    case.  Items with null id or text or under five words are never found, nor is anything
    in a null or empty text.  Of several stretches the nearest, then the first is given.
    A repeated row or item id gives rows of its own.
    """
    spark = docs.sparkSession
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, distance int, first_word long, last_word long"
    out = spark.createDataFrame([], schema)
    for pieces in _blocks(items, rate):
        shared = spark.sparkContext.broadcast(pieces)

        def run(batches, shared=shared):
            for batch in batches:
                rows = list(shared.value.matches(batch.column(1)))
                if rows:
                    at, item, d, s, t = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(item, pa.int64()), pa.array(d, pa.int32()),
                         pa.array(s, pa.int64()), pa.array(t, pa.int64())], ["doc_id", "item_id", "distance", "first_word", "last_word"])

        out = out.unionByName(plain.mapInArrow(run, schema))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The documents in which no test item is found (see find_leaks); all columns stay."""
    spark, at = docs.sparkSession, docs.columns.index("text")
    for pieces in _blocks(items, rate):
        shared = spark.sparkContext.broadcast(pieces)

        def run(batches, shared=shared):
            T.hold()
            for batch in batches:
                hit = np.zeros(batch.num_rows, bool)
                hit[[m[0] for m in shared.value.matches(batch.column(at))]] = True
                yield batch.filter(pa.array(~hit))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
