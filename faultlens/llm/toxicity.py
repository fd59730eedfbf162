"""Toxicity by a logistic classifier that is held to counterfactual fairness.

Features are the presence of words and of word beginnings.  Training also looks at each
labelled text that names a group of people, with the name swapped for another of its kind,
and penalises any change of the score, so naming a group is not evidence in itself.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultlens.llm import textops as T
from faultlens.llm.store import Tables, pick

SAMPLE = 20_000  #: labelled documents the classifier is fitted on at most, those with the smallest hash of their id
FEATURES = 6_000  #: features kept, by the strength of their link with the label
STEMS = (4, 5, 6)
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+")

# Names of groups of people that may stand for one another, by kind and language.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "bisexual"),
    ("immigrants", "natives", "refugees"), ("young", "old"), ("disabled", "abled"),
    ("frauen", "männer"), ("christen", "muslime", "juden"), ("ausländer", "inländer", "flüchtlinge"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"), ("immigrés", "réfugiés"),
    ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"), ("inmigrantes", "refugiados"),
)
SWAPS = {w: kind[(k + 1) % len(kind)] for kind in IDENTITIES for k, w in enumerate(kind)}


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def traits(found: set[str]) -> set[str]:
    """The words and their beginnings of a few lengths."""
    return found | {f"{w[:n]}-" for w in found for n in STEMS if len(w) > n}


def swapped(found: set[str]) -> set[str]:
    return {SWAPS.get(w, w) for w in found}


def in_fold(doc_id: int, fold: int = 1, folds: int = 3) -> bool:
    return zlib.crc32(str(doc_id).encode()) % folds == fold


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of labelled documents outside the held-out fold, at most ``rows``.

    Ids are drawn before any text is read: the ``rows`` with the smallest hash, a list of
    bounded size that every task filters its documents with.
    """
    seen = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seen = seen.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    drawn = seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    joined = pick(docs, "doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return joined.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))


def _counts(sample: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 200):  # partial counts of few texts, so that a task holds little
                good, bad = Counter(), Counter()
                part = batch.slice(k, 200)
                for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    (bad if y else good).update(traits(words(text)))
                names = list(good.keys() | bad.keys())
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([bad[x] for x in names], pa.int64()), pa.array([good[x] for x in names], pa.int64())], ["trait", "bad", "good"])

    return sample.mapInArrow(run, "trait string, bad long, good long").groupBy("trait").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _rows(sample: DataFrame, number: dict[str, int]) -> list:
    """(toxic, feature numbers, feature numbers after the swap or None) of each sampled text."""
    def run(batches):
        for batch in batches:
            out = []
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                x = sorted(number[t] for t in traits(found) if t in number)
                other = sorted(number[t] for t in traits(swapped(found)) if t in number) if found & SWAPS.keys() else None
                out.append({"y": y, "x": x, "z": other})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("y", pa.int32()), ("x", pa.list_(pa.int32())), ("z", pa.list_(pa.int32()))]))

    return sample.mapInArrow(run, "y int, x array<int>, z array<int>").collect()


def fit(x: list, y: np.ndarray, z: list, size: int, fairness: float = 4.0, ridge: float = 2e-5, rounds: int = 400, rate: float = 0.1) -> np.ndarray:
    """Weights, the last one the constant: logistic loss, ridge, and the squared score change under swaps.

    The rarer label weighs more, by the root of the ratio of the two.
    """
    def sparse(lists):
        return np.repeat(np.arange(len(lists)), [len(v) for v in lists]), np.fromiter((i for v in lists for i in v), np.int64)

    row, col = sparse(x)
    pairs = [k for k, v in enumerate(z) if v is not None]
    ra, ca = sparse([x[k] for k in pairs])
    rb, cb = sparse([z[k] for k in pairs])
    n = len(y)
    share = np.where(y > 0, np.sqrt((y == 0).sum() / max(1, (y > 0).sum())), 1.0)
    share /= share.sum()
    w, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[col], minlength=n) + w[-1], -40, 40)))
        g = np.empty_like(w)
        g[:-1] = np.bincount(col, ((p - y) * share)[row], minlength=size) + 2 * ridge * w[:-1]
        g[-1] = ((p - y) * share).sum()
        if pairs:
            d = np.bincount(ra, w[ca], minlength=len(pairs)) - np.bincount(rb, w[cb], minlength=len(pairs))
            g[:-1] += 2 * fairness / len(pairs) * (np.bincount(ca, d[ra], minlength=size) - np.bincount(cb, d[rb], minlength=size))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-8)
    return w


class Model:
    def __init__(self, weights: dict[str, float], constant: float):
        self.weights, self.constant = weights, constant

    def score(self, text: str | None) -> float:
        s, get = self.constant, self.weights.get
        found = words(text)
        for t in sorted(t for t in traits(found) if t in self.weights):  # one order, so that sums are repeatable
            s += get(t)
        return float(1 / (1 + np.exp(-min(max(s, -40.0), 40.0))))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, features: int = FEATURES) -> Model:
    """Classifier from at most ``rows`` labelled texts; the held-out fold takes no part.

    Rows with null id or label are left out, equal texts count once.  Without labelled
    texts of both kinds the score is the smoothed share of toxic ones.
    """
    tables = Tables(docs.sparkSession, "toxic")
    drawn = tables.keep(_sample(docs, labels, rows))
    sample = tables.keep(drawn.dropDuplicates(["text", "toxic"]))
    tables.drop(drawn)
    size = {r[0]: r[1] for r in sample.groupBy(F.col("toxic") > 0).agg(F.count("*")).collect()}
    bad, good = size.get(True, 0), size.get(False, 0)
    prior = (bad + 1) / (bad + good + 2)
    if not bad or not good:
        return Model({}, float(np.log(prior / (1 - prior))))
    rate = bad / (bad + good)
    z = (F.col("bad") - (F.col("bad") + F.col("good")) * rate) / F.sqrt((F.col("bad") + F.col("good")) * rate * (1 - rate))
    chosen = _counts(sample).where(F.col("bad") + F.col("good") >= 3).withColumn("z", F.abs(z)).where("z >= 3")
    names = sorted(r[0] for r in chosen.orderBy(F.desc("z"), "trait").limit(features).select("trait").collect())
    names = sorted({*names, *SWAPS})
    got = _rows(sample, {t: i for i, t in enumerate(names)})
    tables.drop(sample)
    w = fit([r[1] for r in got], np.array([1.0 if r[0] else 0.0 for r in got]), [r[2] for r in got], len(names))
    return Model({t: float(v) for t, v in zip(names, w) if abs(v) > 1e-9}, float(w[-1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; a null text scores like an empty one.

    A null doc_id counts as not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        T.hold()
        for batch in batches:
            s = np.array([shared.value.score(t) for t in batch.column(1).to_pylist()], float)
            held = [d is not None and in_fold(d) for d in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.bool_()), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return plain.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that score below the threshold, all columns unchanged."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches):
        T.hold()
        for batch in batches:
            yield batch.filter(pa.array([shared.value.score(t) < THRESHOLD for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
