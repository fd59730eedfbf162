"""Isolation forest (Liu, Ting and Zhou, 2008) grown on Spark.

Each tree is grown in a task of its own from its own sample of at most 256 points,
drawn from all points of its group by a seeded hash.  The points of a task are split
level by level as numpy arrays.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EULER_GAMMA = 0.5772156649015329
TREES = 100
SUBSAMPLE = 256
SEED = 42

FOREST_FIELDS = (
    "n_trees int, psi int, dims int, feature array<int>, threshold array<double>, "
    "child array<int>, path array<double>"
)


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2.0)
    grown = 2.0 * (np.log(safe - 1.0) + EULER_GAMMA) - 2.0 * (safe - 1.0) / safe
    return np.where(n > 2, grown, np.where(n == 2, 1.0, 0.0))


def _picks(rng: np.random.Generator, n: int, psi: int) -> np.ndarray:
    """The ``psi`` of ``n`` points with the smallest of n random numbers."""
    noise = rng.random(n)
    low = np.flatnonzero(noise < 2.0 * psi / n)
    low = low if len(low) >= psi else np.arange(n)
    return low[np.argpartition(noise[low], psi - 1)[:psi]]


def grow(points: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> dict:
    """Grow a forest on an (n, dims) array; nodes of all trees lie in flat arrays.

    ``child[i]`` is the left child of node i (the right one follows it), or -1 at a
    leaf; ``path`` holds a leaf's depth plus the mean depth of what it still holds.
    The first ``trees`` nodes are the roots.
    """
    rng = np.random.default_rng(seed)
    n, dims = points.shape
    psi = min(subsample, n)
    limit = int(np.ceil(np.log2(max(psi, 2))))
    data = points[np.concatenate([_picks(rng, n, psi) for _ in range(trees)])]
    node = np.repeat(np.arange(trees), psi)
    feature = [np.zeros(trees, dtype=np.int32)]
    threshold = [np.zeros(trees)]
    child = [np.full(trees, -1, dtype=np.int32)]
    path = [np.zeros(trees)]
    base, width = 0, trees
    for depth in range(limit + 1):
        # `node` is the row's node within this level, in ascending order; finished rows are gone.
        size = np.bincount(node, minlength=width)
        starts = np.minimum(np.cumsum(size) - size, len(node) - 1)
        low = np.minimum.reduceat(data, starts, axis=0)
        high = np.maximum.reduceat(data, starts, axis=0)
        varies = high > low
        split = varies.any(axis=1) & (size > 1) if depth < limit else np.zeros(width, dtype=bool)
        path[-1][:] = np.where(split, 0.0, depth + average_path(size))
        if not split.any():
            break
        choice = np.argmax(np.where(varies, rng.random((width, dims)), -1.0), axis=1)
        rows = np.arange(width)
        with np.errstate(invalid="ignore"):
            cut = low[rows, choice] + rng.random(width) * (high[rows, choice] - low[rows, choice])
        feature[-1][:] = choice
        threshold[-1][:] = np.where(split, cut, 0.0)
        order = np.cumsum(split) - 1
        child[-1][:] = np.where(split, base + width + 2 * order, -1)
        keep = split[node]
        data, node = data[keep], node[keep]
        right = data[np.arange(len(node)), choice[node]] > cut[node]
        node = 2 * order[node] + right
        by_node = np.argsort(node, kind="stable")
        data, node = data[by_node], node[by_node]
        base += width
        width = 2 * int(split.sum())
        feature.append(np.zeros(width, dtype=np.int32))
        threshold.append(np.zeros(width))
        child.append(np.full(width, -1, dtype=np.int32))
        path.append(np.zeros(width))
    return {
        "n_trees": trees, "psi": psi, "dims": dims,
        "feature": np.concatenate(feature), "threshold": np.concatenate(threshold),
        "child": np.concatenate(child), "path": np.concatenate(path),
    }


def isolation_score(model: dict, points: np.ndarray) -> np.ndarray:
    """-2^(-E[h]/c(psi)) per point: near -1 is isolated, near -0.5 or above is normal."""
    trees, psi = int(model["n_trees"]), int(model["psi"])
    feature, threshold = np.asarray(model["feature"]), np.asarray(model["threshold"])
    child, path = np.asarray(model["child"]), np.asarray(model["path"])
    out = np.empty(len(points))
    for start in range(0, len(points), 2048):
        part = points[start:start + 2048]
        at = np.tile(np.arange(trees), (len(part), 1))
        rows = np.arange(len(part))[:, None]
        while True:
            nxt = child[at]
            inner = nxt >= 0
            if not inner.any():
                break
            goes_right = part[rows, feature[at]] > threshold[at]
            at = np.where(inner, nxt + goes_right, at)
        out[start:start + len(part)] = path[at].mean(axis=1)
    scale = float(average_path(psi)) or 1.0
    return -np.power(2.0, -out / scale)


def tree_samples(rows: DataFrame, keys: Sequence[str], identity: Sequence[str], trees: int = TREES, size: int = SUBSAMPLE,
                 seed: int = SEED) -> DataFrame:
    """Rows with the number of a tree that trains on them, in ``_tree``.

    Each tree takes the ``size`` rows of its group with the smallest hash of tree and
    identity, out of all rows.  In a group of n rows only hashes in the lowest
    2 * size / n can be among them (but for a chance under 1e-20), so few rows are
    copied; a tree's rows meet in a group of their own.
    """
    named = rows.withColumn("_k", F.to_json(F.struct(*keys)))  # one text per group, so that NULL keys meet too
    sized = named.join(named.groupBy("_k").agg(F.count(F.lit(1)).alias("_rows")), "_k")
    share = F.least(F.lit(1.0), F.lit(2.0 * size) / F.col("_rows"))
    marks = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("_tree"), F.xxhash64(F.lit(seed), t, *identity).alias("_mark")))
    # The hash is a signed number of 64 bits.
    low = F.filter(marks, lambda m: m["_mark"].cast("double") / F.lit(2.0**64) + 0.5 <= share)
    out = sized.select(*rows.columns, F.inline(low))
    w = W.partitionBy(*keys, "_tree").orderBy("_mark", *identity)
    return out.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= size).drop("_n", "_mark")


def joined_trees(trees: Sequence[dict]) -> dict:
    """Trees of one root each as one forest; the roots come first."""
    n = len(trees)
    firsts = n + np.cumsum([0, *[len(t["feature"]) - 1 for t in trees]])
    child = [np.where(np.asarray(t["child"]) >= 0, np.asarray(t["child"]) - 1 + firsts[i], -1) for i, t in enumerate(trees)]
    parts = {"feature": [np.asarray(t["feature"]) for t in trees], "threshold": [np.asarray(t["threshold"]) for t in trees],
             "child": child, "path": [np.asarray(t["path"]) for t in trees]}
    flat = {k: np.concatenate([np.array([x[0] for x in v]), *[x[1:] for x in v]]) for k, v in parts.items()}
    flat["child"], flat["feature"] = flat["child"].astype("int32"), flat["feature"].astype("int32")
    return {"n_trees": n, "psi": max(t["psi"] for t in trees), "dims": trees[0]["dims"], **flat}


def fit_isolation_forest(rows: DataFrame, keys: Sequence[str], features: Column, identity: Sequence[str],
                         trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> DataFrame:
    """One forest per group as a row of arrays; a NULL key is a group like others.

    ``features`` is an array column.  Every tree is grown in a task of its own from its
    own sample of the group; the trees of a group, of bounded size, are then joined.
    """
    key_types = rows.select(*keys).schema
    ids = [f"_i{n}" for n in range(len(identity))]
    data = rows.select(*keys, *[F.col(c).alias(n) for c, n in zip(identity, ids, strict=True)], features.alias("_x"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in key_types.fields)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ids)
        tree = int(pdf["_tree"].iloc[0])
        model = grow(np.stack(pdf["_x"].to_list()).astype(float), 1, subsample, seed + tree)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "_tree": [tree], **{name: [value] for name, value in model.items()}})

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        model = joined_trees(pdf.sort_values("_tree").to_dict("records"))
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, **{name: [value] for name, value in model.items()}})

    grown = tree_samples(data, keys, ids, trees, subsample, seed).groupBy(*keys, "_tree").applyInPandas(fit, f"{head}, _tree int, {FOREST_FIELDS}")
    return grown.groupBy(*keys).applyInPandas(join, f"{head}, {FOREST_FIELDS}")


def score_isolation_forest(points: DataFrame, models: DataFrame, keys: Sequence[str], features: Column,
                           block: int = 4096) -> DataFrame:
    """Add ``iso_score``.  Points are scored in blocks next to one copy of their model.

    A block is a bounded number of points of one group, so a group with most of the
    rows is scored by many tasks and a model is shipped once per block, not per point.
    """
    columns = points.columns
    group = F.to_json(F.struct(*keys)).alias("_k")  # one text per group, so that NULL keys meet too
    rows = points.select(*columns, features.alias("_x"), group)
    blocks = rows.groupBy("_k").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    spread = rows.join(blocks, "_k").withColumn(
        "_block", F.pmod(F.xxhash64(*[c for c in columns if c not in keys], "_x"), F.col("_blocks")).cast("int"))
    numbers = blocks.select("_k", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
    copies = models.withColumn("_k", group).join(numbers, "_k")

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return left[columns].assign(iso_score=np.nan).iloc[:0]
        x = np.stack(left["_x"].to_list()).astype(float)
        return left[columns].assign(iso_score=isolation_score(right.iloc[0].to_dict(), x))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema.fields)
    by = ["_k", "_block"]
    return (
        spread.drop("_blocks").groupBy(*by).cogroup(copies.groupBy(*by))
        .applyInPandas(score, f"{fields}, iso_score double")
    )
