"""Sequence packing by non-negative least squares over shallow length combinations.

Documents are cut into full windows and one rest each.  The histogram of rest lengths is
all the planner sees.  It enumerates combinations of two and three lengths that fill a
window, solves for how often to use each, rounds down, and packs what is left greedily,
largest first.  Rests then take their places by length and rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultlens.llm.store import Tables, pick
from faultlens.llm.tokens import END_ID, closed, crc, tokenizer_path, word_ids

WINDOW = 2048
TRIPLES = 4096  #: combinations of three lengths that are tried
ROUNDS = 300


def _cut(docs: DataFrame, path: str, window: int, end_id: int) -> DataFrame:
    """(task, doc_id, start, length, ids_crc32, doc_tokens, place) of every piece; place numbers a task's pieces of one length."""
    def run(batches):
        from pyspark import TaskContext

        task, ids_of = TaskContext.get().partitionId(), word_ids(path)
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            doc = batch.column(0).to_pylist()
            for lo, ids, bounds in ids_of.encode(batch.column(1)):
                rows = []
                for k, x in enumerate(closed(ids, bounds, end_id)):
                    for at in range(0, len(x), window):
                        piece = x[at:at + window]
                        rows.append((doc[lo + k], at, len(piece), crc(piece), len(x), int(seen[len(piece)])))
                        seen[len(piece)] += 1
                yield pa.RecordBatch.from_pylist([dict(zip(names, (task, *r))) for r in rows], schema=arrow)

    names = ["task", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "place"]
    arrow = pa.schema([(n, pa.int32() if n == "task" else pa.int64()) for n in names])
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "task int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long")


def combinations(counts: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Two or three lengths with a sum of ``window``; of the triples those with the most common lengths."""
    have = np.flatnonzero(counts)
    pairs = [(int(a), int(window - a)) for a in have if a <= window - a < window and counts[window - a]]
    big = have[np.argsort(-counts[have], kind="stable")][:256]
    a, b = np.meshgrid(big, big, indexing="ij")
    a, b = a[a <= b], b[a <= b]
    c = window - a - b
    ok = c >= b
    a, b, c = a[ok], b[ok], c[ok]
    ok = counts[c] > 0
    a, b, c = a[ok], b[ok], c[ok]
    best = np.argsort(-np.minimum(np.minimum(counts[a], counts[b]), counts[c]), kind="stable")[:TRIPLES]
    return pairs + [(int(x), int(y), int(z)) for x, y, z in zip(a[best], b[best], c[best])]


def repeats(shapes: list[tuple[int, ...]], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative x with the sum of x times the lengths of each shape close to the histogram.

    Accelerated projected gradient on the squared error.
    """
    if not shapes:
        return np.zeros(0)
    rows = np.concatenate([np.array(s) for s in shapes])
    cols = np.repeat(np.arange(len(shapes)), [len(s) for s in shapes])
    n, h = len(shapes), counts.astype(float)
    degree = np.bincount(rows, minlength=len(counts))
    step = 1.0 / (3 * degree.max())  # at least the inverse of the largest eigenvalue's bound
    x = np.zeros(n)
    y, t = x.copy(), 1.0
    for _ in range(rounds):
        error = np.bincount(rows, y[cols], minlength=len(counts)) - h
        new = np.maximum(0, y - step * np.bincount(cols, error[rows], minlength=n))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats): sequences that use every counted length exactly as often as it occurs."""
    left, out = counts.astype(np.int64).copy(), []
    if window <= len(left) - 1 and left[window]:
        out.append(((window,), int(left[window])))
        left[window] = 0
    shapes = combinations(left, window)
    x = repeats(shapes, left)
    for k in np.argsort(-x, kind="stable"):
        shape = shapes[k]
        need = np.bincount(shape, minlength=len(left))
        used = np.flatnonzero(need)
        r = int(min(np.floor(x[k] + 1e-6), (left[used] // need[used]).min()))
        if r > 0:
            out.append((shape, r))
            left[used] -= r * need[used]
    # Greedy rest: a sequence starts with the largest length and takes the largest that fit.
    while True:
        have = np.flatnonzero(left)
        if not len(have):
            return out
        shape, room = [], window
        taken: dict[int, int] = {}
        while room and len(have):
            k = int(np.searchsorted(have, room, side="right")) - 1
            if k < 0:
                break
            size = int(have[k])
            fit = min(room // size, int(left[size]))
            shape += [size] * fit
            taken[size] = fit
            room -= fit * size
            have = have[:k]
        r = min(int(left[s]) // f for s, f in taken.items())
        for s, f in taken.items():
            left[s] -= r * f
        out.append((tuple(shape), r))


def _runs(shapes: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank, sequence of that rank and offset there; ranks count up within a run."""
    runs: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for shape, r in shapes:
        offset = 0
        for size in shape:
            runs.setdefault(size, []).append((ranks.get(size, 0), sequence, offset))
            ranks[size] = ranks.get(size, 0) + r
            offset += size
        sequence += r
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in runs.items()}


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    Each document is its token ids and the end id, cut every ``window`` ids.  Null and empty
    texts are the end id alone.  Pieces of a sequence lie side by side from 0 and sum to at
    most ``window``.  Rows with equal or null doc_id are documents of their own.  What goes
    through the driver is the histogram, ``window`` numbers for any amount of text; the
    plan has at most about two runs for each combination and length.
    """
    spark = docs.sparkSession
    tables = Tables(spark, "pack")
    pieces = tables.keep(_cut(docs, tokenizer or tokenizer_path(), window, end_id))
    made = tables.keep(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    counts = np.zeros(window + 1, np.int64)
    for size, n in made.groupBy("length").agg(F.sum("n")).collect():  # a row for each length at most
        counts[size] = n
    runs = spark.sparkContext.broadcast(_runs(plan(counts, window)))
    from pyspark.sql import Window

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = made.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def place(batches):
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            order = np.argsort(size, kind="stable")
            edges = np.flatnonzero(np.diff(size[order])) + 1
            for part in np.split(order, edges) if len(order) else []:
                first, base, off = runs.value[int(size[part[0]])]
                k = np.searchsorted(first, rank[part], side="right") - 1
                sequence[part] = base[k] + rank[part] - first[k]
                offset[part] = off[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    ranked = pieces.join(before, ["length", "task"]).select(*names, (F.col("before") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
