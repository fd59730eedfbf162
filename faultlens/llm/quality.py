"""Quality rules: counts of each text, an isolation forest over their ratios, thresholds from labelled rows.

Every text gets the counts the fixed rules read and a few more.  Their ratios, which do not
grow with the text, are the forest's features.  Each tree splits a small sample of rows that
pass the fixed rules at random; rows that are isolated after few splits are anomalous.  How
anomalous a row may be is learnt from labelled rows, for each class of lengths by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultlens.llm import textops as T
from faultlens.llm.store import Tables, pick

TREES, SAMPLE, POOL = 100, 256, 25_600  #: trees, rows a tree sees (about), rows drawn from the table for all trees
LEAST_WORDS, MOST_REPEATED = 50, 50  #: fixed rules: words a text needs, per cent of its words that may lie in repeated windows
LOSS, BINS = 0.005, 1000  #: share of good labelled rows a threshold may reject; steps of a score
LENGTHS = (0, 150, 600)  #: classes of lengths, in words from which on; each has its own threshold
ENOUGH = 100  #: good labelled rows a class needs for a threshold of its own

# The symbols and the line break of the rules.
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_upper", "n_letters", "n_marks", "n_bare")
FEATURES = ("word_length", "symbols", "repeated", "upper", "marks", "bare")


def _flags(codes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(codes)] = True
    return out


_UPPER, _DIGIT = _flags(range(65, 91)), _flags(range(48, 58))
_LETTER = _flags([*range(65, 91), *range(97, 123), *range(128, 256)])
_MARK = _flags(x for x in range(33, 127) if not chr(x).isalnum())


def _within(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    run = np.concatenate([[0], np.cumsum(flags)])
    at = offsets - offsets[0]
    return run[at[1:]] - run[at[:-1]]


def _again(row: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (row, hash): whether it occurs twice or more, and whether it occurs earlier."""
    key = T.mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = later[order[1:][same]] = True
    return twice, later


def counts_of(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of some rows, given as bytes and row offsets."""
    rows = len(offsets) - 1
    body = raw[int(offsets[0]):int(offsets[-1])]
    point = (body & 0xC0) != 0x80
    inside = T.SPACED[body]
    w = T.words(raw, offsets, T.SPACED, T.EXACT)
    n = np.diff(w.bounds)
    out = {"n_words": n, "word_chars": _within(inside & point, offsets), "n_symbols": _within(_flags(SYMBOLS)[body], offsets)}

    lines = T.words(raw, offsets, T.table([0x0A]), T.EXACT)  # what lies between line feeds
    held = np.concatenate([[0], np.cumsum(inside)])
    base = offsets[lines.row] - offsets[0]
    full = held[base + lines.end] > held[base + lines.start]
    row = lines.row[full]
    out["n_dup_lines"] = np.bincount(row[_again(row, lines.hash[full])[1]], minlength=rows)

    grams, covered = T.ngrams(w.hash, 3), np.zeros(len(w.hash), bool)
    at = np.flatnonzero(w.row[2:] == w.row[:-2]) if len(w.hash) > 2 else np.zeros(0, int)
    at = at[_again(w.row[at], grams[at])[0]]
    for k in range(3):
        covered[at + k] = True
    out["n_repeat_words"] = np.bincount(w.row[covered], minlength=rows)

    spot = offsets[w.row] - offsets[0]
    named = np.concatenate([[0], np.cumsum((_LETTER | _DIGIT)[body])])
    out["n_bare"] = np.bincount(w.row[named[spot + w.end] == named[spot + w.start]], minlength=rows)
    for name, flags in (("n_upper", _UPPER), ("n_letters", _LETTER), ("n_marks", _MARK)):
        out[name] = _within(flags[body] & point, offsets)
    return out


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, text hash, counts) of each row; a null text counts like an empty one, with zeros."""
    names = [*COUNTS, *MORE]

    def run(batches):
        T.hold()
        for batch in batches:
            for lo, hi, raw, offsets in T.slices(batch.column(1)):
                found = counts_of(raw, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), *(pa.array(found[c].astype(np.int64)) for c in names)], ["doc_id", "t", *names])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"))
    return plain.mapInArrow(run, "doc_id long, t long, " + ", ".join(f"{c} long" for c in names))


def features(x: dict[str, np.ndarray]) -> np.ndarray:
    """Ratios of the counts (FEATURES), a row each; they do not grow with the text."""
    def share(a, b):
        return np.asarray(a, float) / np.maximum(1, np.asarray(b, float))

    chars, n = x["word_chars"], x["n_words"]
    return np.column_stack([
        share(chars, n), share(x["n_symbols"], chars), share(x["n_repeat_words"], n),
        share(x["n_upper"], x["n_letters"]), share(x["n_marks"], chars), share(x["n_bare"], n),
    ])


def mean_path(n) -> np.ndarray:
    """Mean depth at which a random tree of n rows ends."""
    n = np.asarray(n, float)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, seed: int) -> dict[str, list]:
    """One tree of random splits down to the depth a balanced one would have: arrays by node; a leaf has feature -1."""
    rng = np.random.default_rng(seed)
    most = int(np.ceil(np.log2(max(2, len(x)))))
    feature, cut, left, right, length = [], [], [], [], []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        node = len(feature)
        if parent >= 0:
            (right if side else left)[parent] = node
        lo, hi = (x[rows].min(0), x[rows].max(0)) if len(rows) else (np.zeros(x.shape[1]),) * 2
        usable = np.flatnonzero(lo < hi)
        done = depth >= most or len(rows) < 2 or not len(usable)
        f = -1 if done else int(rng.choice(usable))
        at = 0.0 if done else float(rng.uniform(lo[f], hi[f]))
        if not done and at <= lo[f]:  # a split leaves something on both sides
            at = float(np.nextafter(lo[f], hi[f]))
        feature.append(f)
        cut.append(at)
        left.append(0)
        right.append(0)
        length.append(depth + float(mean_path(len(rows))) if done else 0.0)
        if not done:
            low = x[rows, f] < at
            todo += [(rows[~low], depth + 1, node, 1), (rows[low], depth + 1, node, 0)]
    return {"feature": feature, "cut": cut, "left": left, "right": right, "length": length}


class Forest:
    """Trees as arrays; ``score`` is between 0 and 1, higher for rows that are isolated sooner."""

    def __init__(self, trees: list[dict], seen: float):
        self.trees, self.usual = [{k: np.asarray(v) for k, v in t.items()} for t in trees], max(float(mean_path(seen)), 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.zeros(len(x))
        total, every = np.zeros(len(x)), np.arange(len(x))
        for t in self.trees:
            node = np.zeros(len(x), np.int64)
            while True:
                f = t["feature"][node]
                go = f >= 0
                if not go.any():
                    break
                low = x[every, np.maximum(f, 0)] < t["cut"][node]
                node = np.where(go, np.where(low, t["left"][node], t["right"][node]), node)
            total += t["length"][node]
        return 2.0 ** (-total / len(self.trees) / self.usual)


def fit(stats: DataFrame, trees: int = TREES, sample: int = SAMPLE, pool: int = POOL, seed: int = 0) -> Forest:
    """A forest from the ``pool`` rows of smallest hash, of which each tree draws about ``sample`` by a hash of its own.

    Trees grow in tasks of their own; what comes back is their nodes, whose number the
    parameters bound.  The same rows give the same forest in any order.
    """
    names = [*COUNTS, *MORE]
    drawn = stats.select(F.xxhash64(F.lit(seed), "doc_id", "t").alias("h"), *names).orderBy("h", *names).limit(pool)
    tables = Tables(stats.sparkSession, "forest")
    drawn = tables.keep(drawn)
    n = drawn.count()
    if n == 0:
        return Forest([], 0)
    share = min(1.0, sample / n)
    dealt = drawn.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    dealt = dealt.where(F.pmod(F.xxhash64("h", "tree"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def one(frame):
        frame = frame.sort_values(["h", *names])
        tree = grow(features({c: frame[c].to_numpy() for c in names}), seed * trees + int(frame["tree"].iloc[0]))
        return frame.iloc[:1][["tree"]].assign(**{k: [v] for k, v in tree.items()})

    grown = dealt.groupBy("tree").applyInPandas(one, "tree int, feature array<int>, cut array<double>, left array<int>, right array<int>, length array<double>")
    rows = sorted(grown.collect(), key=lambda r: r.tree)
    tables.drop(drawn)
    return Forest([{k: r[k] for k in ("feature", "cut", "left", "right", "length")} for r in rows], share * n)


def _class(n):
    """Number of the length class of ``n`` words."""
    return sum(((n >= x).cast("int") for x in LENGTHS[1:]), F.lit(0))


def thresholds(scored: DataFrame, labels: DataFrame, loss: float = LOSS) -> list[float]:
    """For each length class the score from which on rows are rejected; 2 rejects nothing.

    Of the thresholds that reject at most ``loss`` of the good labelled rows it is the one that
    parts bad from good best.  A class with fewer than ENOUGH good rows takes the threshold of
    all; without labels of both kinds nothing is rejected.  Only a histogram leaves the executors.
    """
    known = pick(labels, "doc_id", "quality").where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    bin_ = F.least(F.lit(BINS - 1), F.floor(F.col("score") * BINS)).cast("int")
    seen = scored.join(known, "doc_id").groupBy(_class(F.col("n_words")).alias("c"), (F.col("quality") > 0).cast("int").alias("good"), bin_.alias("bin"))
    counts = np.zeros((len(LENGTHS), 2, BINS), np.int64)
    for c, good, b, n in seen.agg(F.count("*")).collect():  # classes times bins at most
        counts[c, good, b] += n

    def cut(bad: np.ndarray, good: np.ndarray) -> float:
        if not good.sum() or not bad.sum():
            return 2.0
        lost, caught = np.cumsum(good[::-1])[::-1] / good.sum(), np.cumsum(bad[::-1])[::-1] / bad.sum()
        gain = np.where(lost <= loss, caught - lost, -1.0)
        return float(np.argmax(gain) / BINS) if gain.max() > 0 else 2.0

    whole = cut(*counts.sum(0))
    return [cut(*counts[c]) if counts[c, 1].sum() >= ENOUGH and counts[c, 0].sum() else whole for c in range(len(LENGTHS))]


@dataclass
class Rules:
    """The fixed rules, the forest and the thresholds learnt for it."""

    forest: Forest
    least: list[float]
    least_words: int = LEAST_WORDS
    most_repeated: int = MOST_REPEATED

    def failed(self, n_words, n_repeat_words):
        return (n_words < self.least_words) | (100 * n_repeat_words > self.most_repeated * n_words)

    def judge(self, x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(failed a fixed rule, score, kept) of some rows, given their counts."""
        failed, score = self.failed(x["n_words"], x["n_repeat_words"]), self.forest.score(features(x))
        return failed, score, ~failed & (score < np.asarray(self.least)[np.searchsorted(LENGTHS, x["n_words"], "right") - 1])


def _learn(stats: DataFrame, labels: DataFrame, loss: float, least_words: int, most_repeated: int) -> Rules:
    rules = Rules(Forest([], 0), [2.0] * len(LENGTHS), least_words, most_repeated)
    passed = stats.where(~rules.failed(F.col("n_words"), F.col("n_repeat_words")))
    rules.forest = fit(passed)
    rules.least = thresholds(_judged(passed, rules), labels, loss)
    return rules


def _judged(stats: DataFrame, rules: Rules) -> DataFrame:
    shared = stats.sparkSession.sparkContext.broadcast(rules)

    def run(batches):
        T.hold()
        for batch in batches:
            more = shared.value.judge({c: batch.column(c).to_numpy() for c in (*COUNTS, *MORE)})
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, more)], [*batch.schema.names, "base_failed", "score", "kept"])

    return stats.mapInArrow(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in stats.schema)}, base_failed boolean, score double, kept boolean")


def train(docs: DataFrame, labels: DataFrame, loss: float = LOSS, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED) -> Rules:
    """Rules learnt from the documents and the labelled rows among them (``doc_id``, ``quality``)."""
    tables = Tables(docs.sparkSession, "quality")
    stats = tables.keep(statistics(docs))
    rules = _learn(stats, labels, loss, least_words, most_repeated)
    tables.drop(stats)
    return rules


def judge(docs: DataFrame, labels: DataFrame, loss: float = LOSS, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED) -> DataFrame:
    """(doc_id, counts, base_failed, score, kept) of each row.

    ``base_failed`` marks texts of under ``least_words`` words or with over ``most_repeated``
    per cent of their words in windows of three that occur again.  ``kept`` is false for these
    and for texts whose score reaches the threshold of their length class.  Null and empty
    texts have no words and fail; equal rows get equal results; a null doc_id is judged like
    any other but is no labelled row.
    """
    stats = Tables(docs.sparkSession, "quality").keep(statistics(docs))
    return _judged(stats, _learn(stats, labels, loss, least_words, most_repeated)).drop("t")


def keep_good(docs: DataFrame, rules: Rules) -> DataFrame:
    """The rows that the rules keep, all columns unchanged."""
    shared, at = docs.sparkSession.sparkContext.broadcast(rules), docs.columns.index("text")

    def run(batches):
        T.hold()
        for batch in batches:
            for lo, hi, raw, offsets in T.slices(batch.column(at)):
                yield batch.slice(lo, hi - lo).filter(pa.array(shared.value.judge(counts_of(raw, offsets))[2]))

    return docs.mapInArrow(run, docs.schema)
