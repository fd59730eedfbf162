"""Exact top-k by inner product with dual-tree search over cover trees.

Vectors lie in blocks around sampled centres, so a block is a region of space; queries of
neighbouring numbers of centres share a block.  A block of queries meets the blocks of its own centres first;
the kth scores found there are what other blocks must reach: a block pair whose bound is under the worst
of them is not formed.  Few queries make one block, which meets all others once.  In a task both
sides are cover trees: a node has a centre and a radius that holds all its vectors, and its
children, whose centres keep their distance, halve that radius.  A pair of nodes (q, p) can
score at most  <q, p> + |q| r_p + |p| r_q + r_q r_p;  if that is under the worst kth score
of every query in q, the pair is pruned.  Blocks are the upper levels of the same trees.
Lists of all blocks are merged by rank.
"""

from __future__ import annotations

from fractions import Fraction
from math import floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from faultlens.llm.store import Tables, pick

BLOCK, LEAF = 4096, 48
CENTRES = 4096  #: centres at most that every task gets (2 MB at 64 dimensions)
EXACT = float(1 << 53)


class Node:
    __slots__ = ("centre", "radius", "rows", "children", "length")

    def __init__(self, centre, radius, rows, children=()):
        self.centre, self.radius, self.rows, self.children = centre, radius, rows, children
        self.length = float(np.sqrt(centre @ centre))


def cover_tree(x: np.ndarray, rows: np.ndarray | None = None, centre: int | None = None) -> Node:
    """Cover tree over ``rows`` of x; the first row, or ``centre``, is the root's centre.

    Children are at least half the node's radius apart and hold what is within it.  A node
    of up to LEAF rows is a leaf; children that small share one leaf, so that vectors
    without near ones cost no nodes.
    """
    rows = np.arange(len(x)) if rows is None else rows
    mid = x[rows[0] if centre is None else centre]
    dist = np.sqrt(np.maximum(((x[rows] - mid) ** 2).sum(axis=1), 0))
    radius = float(dist.max())
    if len(rows) <= LEAF or radius == 0:
        return Node(mid, radius, rows)
    half, children, loose = radius / 2, [], []
    left, away = rows, dist
    while len(left):
        first = int(np.argmin(away)) if not children and not loose else 0
        c = left[first]
        d = np.sqrt(np.maximum(((x[left] - x[c]) ** 2).sum(axis=1), 0))
        near = d <= half
        own = left[near]
        if len(own) == len(rows):  # nothing is farther than half the radius from this centre
            return Node(mid, radius, rows)
        if len(own) > LEAF:
            children.append(cover_tree(x, own, c))
        else:
            loose.append(own)
        left, away = left[~near], away[~near]
    if loose:
        together = np.concatenate(loose)
        for k in range(0, len(together), 8 * LEAF):
            part = together[k:k + 8 * LEAF]
            children.append(Node(mid, float(np.sqrt(((x[part] - mid) ** 2).sum(axis=1).max())), part))
    return Node(mid, radius, rows, children)


class Best:
    """The k best (score, smaller id) of each query; one more than k is kept where a query may meet itself."""

    def __init__(self, n: int, k: int, least: np.ndarray | None = None):
        self.least = np.full(n, -np.inf) if least is None else least
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.k = k

    def worst(self, rows: np.ndarray) -> float:
        return float(np.maximum(self.score[rows, -1], self.least[rows]).min())

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        s = np.concatenate([self.score[rows], score], axis=1)
        i = np.concatenate([self.id[rows], np.broadcast_to(ids, score.shape)], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, :self.k]
        self.score[rows] = np.take_along_axis(s, order, axis=1)
        self.id[rows] = np.take_along_axis(i, order, axis=1)


def _bound(q: Node, p: Node) -> float:
    b = float(q.centre @ p.centre) + q.length * p.radius + p.length * q.radius + q.radius * p.radius
    return b + 1e-9 * (abs(b) + q.length * p.length)  # rounding never prunes a tie


def search(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int, least: np.ndarray | None = None) -> Best:
    """Best k of x for each row of q, a row with the query's own id left out.

    What cannot reach a query's ``least`` score may be missing.
    """
    best = Best(len(q), k, least)
    stack = [(cover_tree(q), cover_tree(x))]
    while stack:
        a, b = stack.pop()
        if _bound(a, b) < best.worst(a.rows):
            continue
        if not a.children and not b.children:
            s = q[a.rows] @ x[b.rows].T
            s[q_id[a.rows][:, None] == x_id[b.rows]] = -np.inf
            ids = x_id[b.rows]
            if s.shape[1] > k:  # more than k of one leaf cannot stay; ties at the edge are kept for the smaller id
                edge = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
                keep = (s >= np.maximum(edge, best.score[a.rows, -1])[:, None]).any(axis=0)
                s, ids = s[:, keep], ids[keep]
            if len(ids):
                best.add(a.rows, s, ids)
        elif b.children and (not a.children or b.radius >= a.radius):
            stack += sorted(((a, c) for c in b.children), key=lambda n: _bound(*n))
        else:
            stack += [(c, b) for c in a.children]
    return best


def _fine(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): vectors without nulls or non-finite values, as doubles."""
    fine = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))
    return pick(vectors, "vec_id", "embedding").where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: c.cast("double")).alias("x"))


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as Python integers, whatever their size."""
    return np.array([[int(c) * scale if abs(c) >= EXACT else floor(Fraction(c) * scale) for c in row] for row in x.tolist()], dtype=object)


def _exact(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int, scale: int) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of the best k of x for each row of q, in integers of any size."""
    scores = _whole(q, scale) @ _whole(x, scale).T
    out = []
    for i, own in enumerate(q_id.tolist()):
        best = sorted((-s, j) for s, j in zip(scores[i], x_id.tolist()) if j != own)[:k]
        out += [(own, j, -s) for s, j in best]
    return out


def _order(v: int) -> str:
    """A text that sorts like the number, whatever its size: sign, number of digits, digits, nines' complements below zero."""
    text = f"{len(str(abs(v))):06d}{abs(v)}"
    return "1" + text if v >= 0 else "0" + text.translate(_NINES)


_NINES = str.maketrans("0123456789", "9876543210")


FOUND = "query_id long, vec_id long, score long, place string"


def _rows(found: list[tuple[int, int, int]]) -> pd.DataFrame:
    if not found:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "place": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "int64", "place": object})
    a, b, s = zip(*found)
    return pd.DataFrame({"query_id": a, "vec_id": b, "score": [min(max(v, -(1 << 63)), (1 << 63) - 1) for v in s], "place": [_order(v) for v in s]})


def _chained(c: np.ndarray) -> np.ndarray:
    """The rows in an order in which neighbours lie near each other: from one to the nearest that is left."""
    order, left = [0], np.ones(len(c), bool)
    left[0] = False
    while left.any():
        d = ((c - c[order[-1]]) ** 2).sum(axis=1)
        order.append(int(np.where(left, d, np.inf).argmin()))
        left[order[-1]] = False
    return c[order]


def _around_centres(data: DataFrame, scale: int, n: int, block: int) -> DataFrame:
    """The rows with ``spot``, the number of the nearest of some sampled centres of their length, -1 if it has none."""
    drawn = data.orderBy(F.xxhash64("vec_id", "x"), "vec_id", "x").limit(max(1, min(CENTRES, -(-n // block)))).select("x").collect()
    centres: dict[int, list] = {}
    for r in drawn:
        centres.setdefault(len(r.x), []).append(np.floor(np.array(r.x) * scale))
    centres = {d: _chained(np.stack(c)) for d, c in centres.items() if d}

    def run(batches):
        for pdf in batches:
            spot = np.full(len(pdf), -1, np.int32)
            for d, c in centres.items():
                at = np.flatnonzero(pdf["dim"].to_numpy() == d)
                if len(at) and d:
                    v = np.floor(np.stack(pdf["x"].iloc[at].to_numpy()) * scale)
                    spot[at] = ((c * c).sum(axis=1)[None, :] - 2 * v @ c.T).argmin(axis=1)
            yield pdf.assign(spot=spot)

    return data.mapInPandas(run, "vec_id long, x array<double>, dim int, big boolean, spot int")


def _blocks(rows: DataFrame, by: list[str], block: int, name: str) -> DataFrame:
    """The rows with the number of their block of about ``block`` rows within ``by``."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count("*") / block).cast("int").alias("_n"))
    return rows.join(sizes, by).withColumn(name, F.pmod(F.xxhash64("vec_id", "x"), F.col("_n")).cast("int")).drop("_n")


def _query_blocks(query: DataFrame, block: int) -> DataFrame:
    """The queries with their block ``qb`` of about ``block``: centres one after another, one with more queries cut by hash."""
    sizes = query.groupBy("dim", "spot").agg(F.count("*").alias("n"))  # a row a centre
    before = F.coalesce(F.sum("n").over(Window.partitionBy("dim").orderBy("spot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("dim", "spot", F.floor(before / block).cast("int").alias("_first"), F.ceil(F.col("n") / block).cast("int").alias("_n"))
    return query.join(sizes, ["dim", "spot"]).withColumn("qb", F.col("_first") + F.pmod(F.xxhash64("vec_id", "x"), F.col("_n")).cast("int")).drop("_first", "_n")


def _balls(rows: DataFrame, by: list[str], scale: int, worst: bool) -> DataFrame:
    """(by, centre, radius, length, worst) of each block; ``worst`` is the least score its queries still look for."""
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.floor(np.stack(pdf["x"].to_numpy()) * scale)
        mid = v.mean(axis=0)
        return pdf.iloc[:1][by].assign(
            centre=[mid.tolist()], radius=float(np.sqrt(((v - mid) ** 2).sum(axis=1).max())) * (1 + 1e-9), length=float(np.sqrt(mid @ mid)),
            worst=float(pdf["least"].min()) if worst else 0.0)

    kinds = dict(rows.dtypes)
    return rows.groupBy(*by).applyInPandas(one, ", ".join(f"{c} {kinds[c]}" for c in by) + ", centre array<double>, radius double, length double, worst double")


def block_pairs(queries: DataFrame, data: DataFrame, known: DataFrame, scale: int) -> DataFrame:
    """(dim, qb, spot, db): blocks, besides the ``known`` pairs, that can hold one of the k best of a query block."""
    q = _balls(queries, ["dim", "qb"], scale, True).select("dim", "qb", F.col("centre").alias("qc"), F.col("radius").alias("qr"), F.col("length").alias("ql"), "worst")
    p = _balls(data, ["dim", "spot", "db"], scale, False).select("dim", "spot", "db", F.col("centre").alias("pc"), F.col("radius").alias("pr"), F.col("length").alias("pl"))
    dot = F.aggregate(F.zip_with("qc", "pc", lambda a, b: a * b), F.lit(0.0), lambda s, c: s + c)
    bound = dot + F.col("ql") * F.col("pr") + F.col("pl") * F.col("qr") + F.col("qr") * F.col("pr")
    slack = 1e-9 * (F.abs(bound) + F.col("ql") * F.col("pl"))  # rounding never prunes a tie
    return q.join(p, "dim").where(bound + slack >= F.col("worst")).select("dim", "qb", "spot", "db").join(known, ["dim", "qb", "spot", "db"], "left_anti")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Queries are the rows whose vec_id is divisible by ``every``, candidates all rows but
    those with the query's own id; ties go to the smaller vec_id.  Vectors that are null or
    hold null or non-finite components take no part; vectors of another length than the
    query's are no candidates for it.  Repeated rows are candidates each; a repeated query
    row counts once.  Vectors too long for doubles to be exact lie in blocks of their own, whose scores are
    integers of any size; one outside 64 bits is ranked as it is and given as the nearest one inside.
    """
    tables = Tables(vectors.sparkSession, "topk")
    length = F.aggregate("x", F.lit(0.0), lambda s, c: s + c * scale * c * scale)
    # A sum of products is exact in doubles if both lengths multiplied are under 2**53; the margin is for rounding down.
    data = tables.keep(_fine(vectors).select("vec_id", "x", F.size("x").alias("dim"), (length >= EXACT / 4).alias("big")))
    n = data.count()
    plain = tables.keep(_blocks(_around_centres(data.where("not big"), scale, n, block), ["dim", "spot"], block, "db"))
    query = plain.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"]).select("vec_id", "x", "dim", "spot")
    query = tables.keep(_query_blocks(query, block))

    def pair(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return _rows([])
        q_id, x_id = q["vec_id"].to_numpy(), x["vec_id"].to_numpy()
        best = search(np.floor(np.stack(q["x"].to_numpy()) * scale), q_id, np.floor(np.stack(x["x"].to_numpy()) * scale), x_id, k, q["least"].to_numpy(float))
        ok = np.isfinite(best.score)
        return _rows(list(zip(np.repeat(q_id, ok.sum(axis=1)).tolist(), best.id[ok].tolist(), best.score[ok].astype(np.int64).tolist())))

    def searched(asks: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
        rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # columns of their own, though both sides come from one table
        return asks.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(pair, FOUND)

    # The blocks of a query block's own centres.
    keys = ["dim", "qb", "spot", "db"]
    rows = plain.select("vec_id", "x", "dim", "spot", "db")
    own = tables.keep(query.select("dim", "spot", "qb").distinct().join(plain.select("dim", "spot", "db").distinct(), ["dim", "spot"]).select(*keys))
    asks = query.select("vec_id", "x", "dim", "qb").withColumn("least", F.lit(float("-inf")))
    near = tables.keep(searched(asks.join(own, ["dim", "qb"]), rows.join(own, ["dim", "spot", "db"]), keys))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("place"), "vec_id"))
    kth = near.withColumn("rank", rank).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("least"))
    asks = tables.keep(asks.drop("least").join(kth, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf")))))
    # Blocks of other centres, as far as they can reach that.
    found = near
    if query.select("dim", "qb").distinct().join(plain.select("dim", "spot", "db").distinct(), "dim").join(own, keys, "left_anti").limit(1).count():
        pairs = tables.keep(block_pairs(asks, plain, own, scale))
        found = near.unionByName(searched(asks.join(pairs, ["dim", "qb"]), rows.join(pairs, ["dim", "spot", "db"]), keys))

    if data.where("big").limit(1).count():
        asks = data.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
        parts = max(1, -(-n // block))
        part = F.pmod(F.xxhash64("vec_id", "x"), F.lit(parts)).cast("int")
        spread = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

        def exact(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
            out: list[tuple[int, int, int]] = []
            if len(q) and len(x):
                for qs, xs in ((q[q["big"]], x), (q[~q["big"]], x[x["big"]])):
                    if len(qs) and len(xs):
                        out += _exact(np.stack(qs["x"].to_numpy()), qs["vec_id"].to_numpy(), np.stack(xs["x"].to_numpy()), xs["vec_id"].to_numpy(), k, scale)
            return _rows(out)

        # Few vectors are as long as that: each meets the blocks of all others.
        left = asks.select("dim", part.alias("qb"), spread.alias("db"), "vec_id", "x", "big")
        right = data.select("dim", spread.alias("qb"), part.alias("db"), "vec_id", "x", "big")
        found = found.unionByName(left.groupBy("dim", "qb", "db").cogroup(right.groupBy("dim", "qb", "db")).applyInPandas(exact, FOUND))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
