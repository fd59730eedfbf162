"""Secrets in texts: fixed patterns, and strings that a battery of randomness tests takes for keys.

A long run of key-like characters, '=' only as padding at its end, is read in the smallest
encoding that holds it, or in pieces if none does.  Three
tests ask whether its symbols could be uniform and independent: chi-squared over the
alphabet, runs above and below its middle, and serial correlation.  A run that passes must
also be unlike the corpus: the likelihood ratio of the uniform to the corpus's own
characters bounds the chance that ordinary text looks like this, and these bounds go
through a step-up false-discovery procedure of their own for each class of lengths.
"""

from __future__ import annotations

import re
from math import erfc, exp, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultlens.llm import textops as T
from faultlens.llm.store import Tables, pick

# The patterns of the base kinds.  Of assign the value has six characters or more, access 20, hex 24.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?")  # '=' before more of a run parts a name from its value
PIECES = tuple(re.compile(f"{c}{{20,}}") for c in ("[A-Za-z0-9+/]", "[A-Za-z0-9_-]"))
PART = re.compile("[A-Za-z0-9]{20,}")
ENCODINGS = (
    ("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
INDEX = tuple((name, {c: i for i, c in enumerate(a)}, len(a)) for name, a in ENCODINGS)
LENGTHS = (20, 32, 64, 128)  #: classes of lengths by their lower ends
PASS, RATE, BINS = 0.005, 0.05, 400  #: level of the battery, false-discovery rate, steps of 0.1 in -log10 of the bound


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, order of the kind, end, kind) of the fixed patterns; matches that are too short are dropped after matching."""
    out = []
    low = text.lower()
    if "=" in text or ":" in text:
        if any(k in low for k in ("passw", "secret", "token", "api")):
            out += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in HEX_RUN.finditer(text)]
    return sorted(out)


def encoding(run: str):
    """(name, symbol numbers, alphabet size) in the smallest alphabet that holds the run, padding aside."""
    body = run.rstrip("=")
    for name, index, size in INDEX:
        if all(c in index for c in body):
            return name, [index[c] for c in body], size
    return None


def readings(run: str):
    """(start, end, name, symbol numbers, alphabet size, whether it passes the battery) of what a run may hold.

    The run itself, or its longest pieces in either base64 alphabet if no alphabet holds all of
    it.  Of what does not pass, parts between signs are read too: a key may have a name before it.
    """
    body = run.rstrip("=")
    spans = [(0, len(body))] if encoding(run) else sorted({m.span() for p in PIECES for m in p.finditer(body)})
    seen = set(spans)
    for depth in (0, 1):
        more = []
        for a, z in spans:
            name, x, size = encoding(body[a:z])
            ok = battery(x, size) >= PASS
            yield a, len(run) if z == len(body) else z, name, x, size, ok
            if not ok and not depth:
                more += [p for m in PART.finditer(body[a:z]) if (p := (a + m.start(), a + m.end())) not in seen]
                seen.update(more)
        spans = more


def battery(x: list[int], size: int) -> float:
    """Probability of at least this much departure if symbols are uniform and independent (Fisher's combination)."""
    n = len(x)
    counts = np.bincount(x, minlength=size)
    chi = float(((counts - n / size) ** 2).sum() * size / n)
    # Moments of the statistic hold for sparse tables too.
    spread = sqrt(2 * (size - 1) * (n - 1) / n)
    p1 = erfc(max(0.0, (chi - (size - 1)) / spread) / sqrt(2))
    high = np.asarray(x) * 2 >= size
    a = int(high.sum())
    b = n - a
    if a and b:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
        p2 = erfc(abs(runs - mean) / sqrt(2 * var)) if var > 0 else 1.0
    else:
        p2 = 2.0 ** (1 - n)
    d = np.asarray(x) - np.mean(x)
    v = float((d * d).sum())
    p3 = erfc(abs(float((d[1:] * d[:-1]).sum()) / v + 1 / n) * sqrt(n / 2)) if v > 0 else 0.0
    h = -log(max(p1, 1e-300)) - log(max(p2, 1e-300)) - log(max(p3, 1e-300))
    return min(1.0, exp(-h) * (1 + h + h * h / 2))


def bound(x: list[int], size: int, costs: np.ndarray, run: str) -> float:
    """-log10 of a bound on the chance that corpus text is as much more likely to be uniform."""
    return max(0.0, (sum(costs[ord(c)] for c in run[:len(x)]) - len(x) * log(size)) / log(10))


def character_costs(docs: DataFrame) -> np.ndarray:
    """-log of each byte's share among key-like characters of all texts, one added to each count."""
    def run(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            for _, _, raw, off in T.slices(batch.column(0)):
                total += np.bincount(raw[int(off[0]):int(off[-1])], minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256, dtype=np.int32)), pa.array(total)], ["b", "n"])

    counts = np.zeros(256)
    for b, n in docs.select(F.col("text").cast("string")).mapInArrow(run, "b int, n long").groupBy("b").agg(F.sum("n")).collect():
        counts[b] = n
    keys = np.array([ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="])
    costs = np.zeros(256)
    costs[keys] = -np.log((counts[keys] + 1) / (counts[keys].sum() + len(keys)))
    return costs


def _length_class(n: int) -> int:
    return sum(n >= x for x in LENGTHS) - 1


def thresholds(tests: list[tuple[int, int, int]], rate: float = RATE) -> dict[int, int]:
    """Lowest accepted bin of each length class: the largest set whose bound is within its share of the rate."""
    out = {}
    for c in {t[0] for t in tests}:
        bins = np.zeros(BINS + 1, np.int64)
        for k, b, n in tests:
            if k == c:
                bins[b] += n
        above = np.cumsum(bins[::-1])[::-1]
        level = 10.0 ** (-0.1 * np.arange(BINS + 1))
        ok = np.flatnonzero((above > 0) & (level <= rate * above / max(1, bins.sum())))
        out[c] = int(ok[0]) if len(ok) else BINS + 1
    return out


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, base, found) of each row; base and found are arrays of (start, end, kind).

    Places are code points, the end exclusive.  ``found`` has runs of at least twenty key-like
    characters with an encoding's name that pass the battery and the false-discovery step and
    do not overlap a base span; pieces of one run in two alphabets may overlap each other.  Null and empty texts hold nothing; rows stand for themselves.
    """
    tables = Tables(docs.sparkSession, "secrets")
    text = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    costs = character_costs(text)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    test = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("cls", pa.int32()), ("bin", pa.int32())])

    def run(batches):
        for batch in batches:
            base, tests = [], []
            for t in batch.column(1).to_pylist():
                t = t or ""
                spans = base_spans(t)
                base.append([{"start": s, "end": e, "kind": k} for s, _, e, k in spans])
                mine = []
                for m in RUN.finditer(t):
                    for a, z, name, x, size, ok in readings(m[0]):
                        if any(s < m.start() + z and m.start() + a < e for s, _, e, _ in spans):
                            continue
                        away = bound(x, size, costs, m[0][a:z]) if ok else 0.0
                        mine.append({"start": m.start() + a, "end": m.start() + z, "kind": name, "cls": _length_class(len(x)), "bin": min(BINS, int(away * 10))})
                tests.append(mine)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, pa.list_(span)), pa.array(tests, pa.list_(test))], ["doc_id", "base", "tests"])

    spans = "array<struct<start: bigint, end: bigint, kind: string>>"
    found = tables.keep(text.mapInArrow(run, f"doc_id long, base {spans}, tests {spans[:-2]}, cls: int, bin: int>>"))
    counts = found.select(F.explode("tests").alias("x")).groupBy("x.cls", "x.bin").agg(F.count("*")).collect()  # classes times bins at most
    least = thresholds([tuple(r) for r in counts], rate)
    limit = F.create_map(*[F.lit(v) for pair in least.items() for v in pair]) if least else None
    kept = F.filter("tests", lambda x: x["bin"] >= limit[x["cls"]]) if least else F.col("tests")
    return found.select("doc_id", "base", F.transform(kept, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))).alias("found"))
