import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from conftest import docs
from faultlens.llm import periodic
from faultlens.llm.periodic_queries import op12_periodic_runs, planted

WORD = "[^\x20\x09-\x0d]+"


def plain_runs(w, least=24, times=3):
    """All runs by comparing every lag; of one stretch the smallest period counts."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = re.findall(WORD, text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    got = plain_runs(w)
    drop = {i for s, m, q in got for i in range(s + q, s + m)}
    best = max(got, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(got), *best, None if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in got)), sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def periodic_text(rng, size):
    """Words with runs of many periods, some of them broken, nested or side by side."""
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 3)))
    w = []
    while len(w) < size:
        q = rng.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 23, 24, 35, 36, 53, 54, 80, 81, 120, 121, 180])
        unit = [word() for _ in range(q)]
        if rng.random() < 0.3:
            unit = (unit[:max(1, q // 4)] * 5)[:q]
        w += (unit * 12)[:rng.randint(q, min(12 * q, 4 * q + 30))]
        w += [word() for _ in range(rng.randint(0, 20))]
    return w


@pytest.mark.parametrize("seed", range(12))
def test_runs_are_those_of_all_lags(seed):
    rng = random.Random(seed)
    rows = [periodic_text(rng, rng.randint(0, 500)) for _ in range(6)] + [[], ["a"] * 23, ["a"] * 24, ["a", "b"] * 400]
    rows += [["ab"[rng.random() < 0.5] for _ in range(300)], ["ab"[bin(i).count("1") & 1] for i in range(1024)], [str(i) for i in range(200)] * 3 + ["x"]]
    names = {}
    h = np.array([names.setdefault(x, len(names) + 1) for r in rows for x in r], np.uint64)
    got = periodic.runs(periodic.T.mix(h), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))
    want = [(k, *r) for k, w in enumerate(rows) for r in plain_runs(w)]
    assert [tuple(r) for r in got.tolist()] == want and len(want) > 8
    assert len({r[3] for r in want if r[3] > periodic.SHORT}) > 2


def test_scales_cover_all_periods():
    reach = periodic.SHORT
    for low, high, window in periodic.scales(10**7):
        assert low == reach + 1 and window >= 2 and high + window - 1 + high <= periodic.TIMES * low + (high - low) * 2
        assert all(high + window - 1 + q <= periodic.TIMES * q for q in (low, high))
        reach = high
    assert reach >= 10**7


def test_wrong_stretch_hashes_cost_nothing(monkeypatch):
    """Extensions that go too far, as equal hashes of unlike stretches would, are mended word by word."""
    rng = random.Random(2)
    w = [f"n{i}" for i in range(40)] + [f"p{i % 50}" for i in range(200)] + [f"m{i}" for i in range(90)]
    names = {}
    h = periodic.T.mix(np.array([names.setdefault(x, len(names) + 1) for x in w], np.uint64))
    real = periodic._Stretches.reach
    monkeypatch.setattr(periodic._Stretches, "reach", lambda self, i, j, most, back: np.minimum(most, real(self, i, j, most, back) + rng.randint(1, 3)))
    assert [tuple(r) for r in periodic.runs(h, np.array([0, len(w)])).tolist()] == [(0, 40, 200, 50)]


ODD = [None, "", " \t\n ", "x", "a " * 23, "a\x0b" * 24, "é\xa0é " * 30, "A a " * 30, "日本 語 " * 40, "q" * 50_000]


def test_query_is_plain_code(spark, tmp_path, make):
    rng = random.Random(7)
    texts = ODD + [" ".join(periodic_text(rng, rng.randint(1, 160))) for _ in range(150)] + ["\n".join(f"w{rng.randrange(9000)}" for _ in range(rng.randint(1, 90))) for _ in range(150)]
    rows = docs(texts) + [docs(texts)[40]]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(plain_row(r[0], r[1])) for r in rows)
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k in range(len(texts))) > 20


def test_operator_texts_and_empty_tables(make):
    rows = docs(["x y z " * 20 + "end", None, "keep all of this"]) + [(None, "k " * 40, None, None, None)]
    got = {r.doc_id: r for r in periodic.periodic_runs(make(rows)).collect()}
    assert got[0].collapsed == "x y z end" and [tuple(x) for x in got[0].runs] == [(0, 60, 3)] and got[0].n_words == 61
    assert (got[1].n_words, got[1].runs, got[1].collapsed) == (0, [], "")
    assert got[2].collapsed == "keep all of this" and got[None].collapsed == "k"
    assert periodic.periodic_runs(make(rows).limit(0)).count() == 0
    assert [tuple(x) for x in periodic.periodic_runs(make(docs(["a b " * 4])), least=6).first().runs] == [(0, 8, 2)]


def test_a_long_text_with_long_periods(make):
    rng = random.Random(5)
    unit = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    got = periodic.periodic_runs(make(docs([" ".join(["start", *unit * 3, "end"])]))).first()
    assert [tuple(x) for x in got.runs] == [(1, 60_000, 20_000)] and got.collapsed == " ".join(["start", *unit, "end"])


def test_a_null_id_is_not_made_periodic(make):
    got = planted(make([(None, "a b c", None, None, None)])).first()
    assert got.text == "a b c"
