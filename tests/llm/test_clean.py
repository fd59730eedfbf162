import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from brute import check_kept, plain_distance, plain_stretch, words
from faultlens.llm.decontam import budget, decontaminate, find_leaks
from faultlens.llm.editdist import LONG_TEXT, aligned_bound, best_stretch, distance, within, within_all
from faultlens.llm.line_dedup import _simhash, dedup_lines
from faultlens.llm.textops import mix


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=80), st.text("abc", max_size=80))
def test_distance(a, b):
    assert distance(a, b) == plain_distance(a, b)
    if a:
        d, s, e = best_stretch(a, b)
        assert d == plain_stretch(a, b) and plain_distance(a, b[s:e + 1]) == d


def test_bounds_of_long_texts(monkeypatch):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 8)))
    monkeypatch.setattr("faultlens.llm.editdist.LONG_TEXT", 10)
    monkeypatch.setattr("faultlens.llm.editdist.WORDY", 10)
    for _ in range(300):
        w = [word() for _ in range(rng.randint(1, 30))]
        v = list(w)
        for _ in range(rng.randint(0, 8)):
            i = rng.randrange(len(v) + 1)
            v[i:i + rng.randint(0, 2)] = rng.choice([[], [word()], [word(), word()]])
        a, b = " ".join(w), " ".join(v)
        d = plain_distance(a, b)
        assert aligned_bound(a, b) >= d and aligned_bound(a, a) == 0
        for limit in (d - 1, d, 0.2 * max(len(a), len(b))):
            assert within(a, b, limit) == (d <= limit)


def test_many_pairs_at_once(monkeypatch):
    rng = random.Random(8)
    pairs = [("", ""), ("", "a"), ("a", "a"), ("é" * 64, "é" * 65), ("a" * 200, "b" * 200), ("日本語", "日本"), ("x" * 129, "x" * 100 + "y" * 29)]
    for k in range(600):
        a = "".join(rng.choice("abcde é") for _ in range(rng.choice([1, 5, 63, 64, 65, 128, 200, 300])))
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 3))):
            i = rng.randrange(len(b) + 1)
            b[i:i + rng.randint(0, 1)] = rng.choice(["", "f", "gh"])
        pairs.append((a, "".join(b)) if k % 2 else ("".join(b), a))
    a, b = zip(*pairs)
    for long_text in (4000, 100):
        monkeypatch.setattr("faultlens.llm.editdist.LONG_TEXT", long_text)
        monkeypatch.setattr("faultlens.llm.editdist.WORDY", long_text // 40)
        for similarity in (0.8, 0.95, 0.5):
            want = [plain_distance(x, y) <= (1 - similarity) * max(len(x), len(y)) + 1e-9 for x, y in pairs]
            assert within_all(a, b, similarity).tolist() == want
    assert within_all([], [], 0.8).tolist() == []


def test_a_very_long_pair_takes_no_quadratic_time():
    rng = random.Random(7)
    a = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(40_000))
    b = "".join(rng.choice("xyz") if c != " " and rng.random() < 0.1 else c for c in a)
    assert len(a) > 50 * LONG_TEXT and within(a, b, 0.2 * len(a)) and not within(a, a[::-1].replace("a", "q"), 0.01 * len(a))


def test_leaks_are_those_of_brute_force(make, spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 3)))
    items = [(k, " ".join(word() for _ in range(rng.randint(5, 40)))) for k in range(12)] + [(50, "too short"), (51, None), (None, "a b c d e f g"), (52, "")]
    texts = [None, "", "x", "word " * 20_000]
    for k in range(60):
        t = [word() for _ in range(rng.randint(0, 60))]
        w = words(items[k % 12][1])
        for _ in range(rng.randint(0, budget(len(w)) + 2)):
            i = rng.randrange(len(w))
            w[i:i + 1] = rng.choice([[], [word()], [w[i], word()]])
        at = rng.randint(0, len(t))
        texts.append(", ".join(t[:at] + [x.upper() for x in w] + t[at:]))
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)]
    rows += [(None, items[0][1], None, None, None), rows[10]]
    want = set()
    for d, t, *_ in rows:
        for i, p in items:
            p = words(p)
            if i is not None and len(p) >= 5:
                x = plain_stretch(p, words(t))
                if x <= budget(len(p)):
                    want.add((d, i, x))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = find_leaks(make(rows), table).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in got} == want and len(want) > 20
    by = {}
    for d, t, *_ in rows:
        by[d] = t
    for r in got:
        p = words(dict(items)[r.item_id])
        assert plain_distance(p, words(by[r.doc_id])[r.first_word:r.last_word + 1]) == r.distance
    left = decontaminate(make(rows), table)
    hit = {x[0] for x in want}
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r[0]) for r in rows if r[0] not in hit)
    assert left.columns == make(rows).columns
    assert find_leaks(make(rows).limit(0), table).count() == 0
    assert find_leaks(make(rows), table.limit(0)).count() == 0 and decontaminate(make(rows), table.limit(0)).count() == len(rows)


@pytest.mark.parametrize("crowd", [256, 3])
def test_lines_are_those_of_brute_force(make, crowd):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 5)))
    pool = [" ".join(word() for _ in range(n)) for n in (1, 2, 4, 9, 30, 60, 90, 300, 700)]
    texts = [None, "", "\n\n", "---\n---", "z" * 40_000]
    for _ in range(80):
        lines = []
        for _ in range(rng.randint(1, 6)):
            w = rng.choice(pool).split()
            if rng.random() < 0.6:
                w[rng.randrange(len(w))] = word()
            lines.append(rng.choice([" ".join(w), " ".join(w).upper() + ".", "  ".join(w)]) if rng.random() < 0.7 else " ".join(word() for _ in range(20)))
        texts.append("\n".join(lines))
    rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)] + [(None, texts[20], None, None, len(texts[20]))]
    df = make(rows)
    out = dedup_lines(df, crowd=crowd, lost="n_lost")
    assert out.columns == [*df.columns, "n_lost"]
    got = {r.doc_id: r for r in out.collect()}
    assert check_kept(rows, [got[r[0]].text for r in rows], 0.1) > 140  # by edit similarity alone; short lines are edited too
    assert all(r.text is None or r.n_chars == len(r.text) for r in got.values())
    assert dedup_lines(df.limit(0)).count() == 0


def test_simhash_is_the_majority_of_bits():
    rng = np.random.default_rng(3)
    counts = np.array([1, 0, 2, 255, 256, 900])
    h = rng.integers(0, 2**64, counts.sum(), dtype=np.uint64)
    starts = np.cumsum(counts) - counts
    for got, a, n in zip(_simhash(h, starts, counts).tolist(), starts.tolist(), counts.tolist()):
        own = h[a:a + n].tolist()
        tie = int(mix(h[a:a + n].sum(keepdims=True))[0])
        want = 0
        for bit in range(64):
            ones = sum(x >> bit & 1 for x in own)
            want |= (2 * ones > n or bool(n and 2 * ones == n and tie >> bit & 1)) << bit
        assert got == want
