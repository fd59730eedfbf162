"""Bit-parallel edit distance (Myers) over any hashable symbols; Python integers are the bit vectors."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence

import numpy as np


def _scan(pattern: Sequence, text: Sequence, anchored: int):
    m = len(pattern)
    where: dict = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    for j, c in enumerate(text):
        eq = where.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1 | anchored) & full
        pv = (mh << 1) & full | (full & ~(xv | ph))
        mv = ph & xv
        yield j, score


def distance(a: Sequence, b: Sequence, limit: float | None = None) -> int:
    """Edit distance of two whole sequences; what they share at both ends is skipped.

    With a limit, what is returned is a bound that lies on the same side of the limit.
    """
    n = min(len(a), len(b))
    lo = 0
    while lo < n and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < n - lo and a[len(a) - 1 - hi] == b[len(b) - 1 - hi]:
        hi += 1
    a, b = a[lo:len(a) - hi], b[lo:len(b) - hi]
    if not a or not b:
        return len(a) + len(b)
    if limit is not None and max(len(a), len(b)) <= limit:
        return max(len(a), len(b))
    score = 0
    for j, score in _scan(a, b, 1):
        if limit is not None and score - (len(b) - 1 - j) > limit:  # each letter that is left takes one off at most
            return score - (len(b) - 1 - j)
    return score


WORDY = 100  #: letters from which on texts are aligned by their words before the whole distance
GAP = 64  #: letters of a gap between equal words that are compared letter by letter
LONG_TEXT = 4000  #: letters from which on letters are counted too


def _in_order(places: list[int]) -> list[int]:
    """Which of some numbers form a longest ascending sequence."""
    tails, at, back = [], [], []
    for k, p in enumerate(places):
        i = bisect_left(tails, p)
        back.append(at[i - 1] if i else -1)
        if i == len(tails):
            tails.append(p)
            at.append(k)
        else:
            tails[i], at[i] = p, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(k)
        k = back[k]
    return out[::-1]


def aligned_bound(a: str, b: str, limit: float = float("inf")) -> int:
    """An upper bound of the distance: words that each text has once are matched in order, the gaps between compared by themselves.

    Beyond the limit it is not worked out to its end.
    """
    x, y = a.split(" "), b.split(" ")
    once = {w for w, n in Counter(x).items() if n == 1} & {w for w, n in Counter(y).items() if n == 1}
    where = {w: j for j, w in enumerate(y) if w in once}
    left = [i for i, w in enumerate(x) if w in once]
    chosen = [left[k] for k in _in_order([where[x[i]] for i in left])]
    total, i0, j0 = 0, 0, 0
    for i in [*chosen, len(x)]:
        j = where[x[i]] if i < len(x) else len(y)
        if x[i0:i] != y[j0:j]:
            p, q = " ".join(x[i0:i]), " ".join(y[j0:j])
            total += max(len(p), len(q)) if max(len(p), len(q)) > GAP else distance(p, q)
            total += (i == i0) != (j == j0)  # a space more on one side
            if total > limit:
                break
        i0, j0 = i + 1, j + 1
    return total


def _word_by_word(a: str, b: str, limit: float) -> bool:
    """Whether texts of equally many words are that close if each word is compared with the one in its place."""
    x, y = a.split(" "), b.split(" ")
    return len(x) == len(y) and sum(max(len(p), len(q)) for p, q in zip(x, y) if p != q) <= limit


def within(a: str, b: str, limit: float) -> bool:
    """Whether the distance of two texts is at most limit; cheap bounds are tried first.

    Only long texts between the bounds are compared as a whole, which takes time in proportion to the product of their lengths.
    """
    if abs(len(a) - len(b)) > limit:
        return False
    if _word_by_word(a, b, limit):
        return True
    if min(len(a), len(b)) > LONG_TEXT:
        ca, cb = Counter(a), Counter(b)
        if max((ca - cb).total(), (cb - ca).total()) > limit:
            return False
    if min(len(a), len(b)) > WORDY and aligned_bound(a, b, limit) <= limit:
        return True
    return distance(a, b, limit) <= limit


SIDE_BY_SIDE = 16  #: pairs for each 64 letters of the shorter text from which on pairs are compared side by side


LOOK = 32  #: letters after which pairs that are beyond their limit are left out
FEWER = 0.1  #: share of pairs beyond their limit from which on the others are put together


def distances(a: Sequence[str], b: Sequence[str], limit: np.ndarray | None = None) -> np.ndarray:
    """Edit distances of pairs side by side: one letter of every ``b`` at a time against the whole of its ``a``, 64 letters to a word.

    The ``a`` have letters and need equally many words.  With limits, a distance above its own may come out as any number above it.
    """
    order = sorted(range(len(a)), key=lambda i: -len(b[i]))  # longest first, so that those still at work come first
    codes, edges = _codes([a[i] for i in order])
    text, ends = _codes([b[i] for i in order])
    m, n = np.diff(edges), np.diff(ends)
    words = int(-(-m.max() // 64))
    pair = np.repeat(np.arange(len(m)), m)
    letters, which = np.unique(pair << 21 | codes, return_inverse=True)
    place = np.arange(len(codes)) - np.repeat(edges[:-1], m)
    where = np.zeros((words, len(letters) + 1), np.uint64)  # places of each letter of each a; the last column is that of letters it lacks
    np.bitwise_or.at(where, (place >> 6, which), np.uint64(1) << (place & 63).astype(np.uint64))
    sought = np.repeat(np.arange(len(n)), n) << 21 | text
    at = np.minimum(np.searchsorted(letters, sought), len(letters) - 1)
    at = np.where(letters[at] == sought, at, len(letters))
    one, top, end = np.uint64(1), np.uint64(63), ((m - 1) & 63).astype(np.uint64)
    up, down = np.full((words, len(m)), ~np.uint64(0)), np.zeros((words, len(m)), np.uint64)
    score, starts = m.astype(np.int64), ends[:-1]
    most = None if limit is None else np.asarray(limit)[order]
    out, rows, j = np.empty(len(m), np.int64), np.array(order, int), 0
    while len(n) and j < n[0]:
        live = int(np.searchsorted(-n, -j))
        column = at[starts[:live] + j]
        more, less = one, np.uint64(0)
        for k in range(words):
            eq, pv, mv = where[k][column], up[k, :live], down[k, :live]
            xv = eq | mv
            eq |= less
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv), pv & xh
            if k == words - 1:
                score[:live] += (ph >> end[:live] & one).astype(np.int64) - (mh >> end[:live] & one).astype(np.int64)
            next_more, next_less = ph >> top, mh >> top
            ph, mh = ph << one | more, mh << one | less
            up[k, :live], down[k, :live] = mh | ~(xv | ph), ph & xv
            more, less = next_more, next_less
        j += 1
        if most is not None and j % LOOK == 0:
            least = score - np.maximum(n - j, 0)  # each letter that is left takes one off at most
            kept = (n > j) & (least <= most)
            if kept.sum() <= (1 - FEWER) * len(n):
                out[rows[~kept]] = least[~kept]
                up, down, score, n, starts, end, most, rows = up[:, kept], down[:, kept], score[kept], n[kept], starts[kept], end[kept], most[kept], rows[kept]
    out[rows] = score
    return out


TRIPLES = 1024  #: counters a text's letter triples are counted in


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after another, and where each begins, the end included."""
    parts = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    return np.concatenate([*parts, np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])


def _triples(codes: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How often each counter is hit by the letter triples of each text."""
    n = len(edges) - 1
    if len(codes) < 3:
        return np.zeros((n, TRIPLES), np.int32)
    mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    gram = ((mixed[:-2] * np.uint64(31) + mixed[1:-1]) * np.uint64(31) + mixed[2:]) >> np.uint64(54)
    owner = np.repeat(np.arange(n), np.diff(edges))
    inside = owner[:-2] == owner[2:]
    return np.bincount(owner[:-2][inside] * TRIPLES + gram[inside].astype(np.int64), minlength=n * TRIPLES).reshape(n, TRIPLES)


def within_all(a: Sequence[str], b: Sequence[str], similarity: float) -> np.ndarray:
    """Whether each pair's edit distance is at most 1 - similarity of the longer text's length.

    Texts of other lengths, and those that share too few letter triples for it (an edit
    changes three at most), are told apart without a distance; texts that are that close word
    by word, or with equal words matched, need none either.
    """
    size = np.array([[len(x), len(y)] for x, y in zip(a, b, strict=True)], np.int64).reshape(-1, 2)
    longer = size.max(axis=1)
    limit = (1 - similarity) * longer + 1e-9
    ok = longer - size.min(axis=1) <= limit
    close = np.zeros(len(ok), bool)
    for i in np.flatnonzero(ok).tolist():
        close[i] = _word_by_word(a[i], b[i], limit[i])
    ok &= ~close
    for lo in range(0, len(ok), 512):
        some = lo + np.flatnonzero(ok[lo:lo + 512])
        if len(some):
            shared = np.minimum(_triples(*_codes([a[i] for i in some])), _triples(*_codes([b[i] for i in some]))).sum(axis=1)
            ok[some] = shared >= longer[some] - 2 - 3 * np.floor(limit[some])
    for i in np.flatnonzero(ok & (size.min(axis=1) > WORDY)).tolist():
        close[i] = aligned_bound(a[i], b[i], limit[i]) <= limit[i]
    ok &= ~close
    words = -(-size.min(axis=1) // 64)
    for k in np.unique(words[ok]).tolist():
        some = np.flatnonzero(ok & (words == k)).tolist()
        if k and len(some) >= SIDE_BY_SIDE * k:
            pairs = [sorted((a[i], b[i]), key=len) for i in some]
            ok[some] = distances([x for x, _ in pairs], [y for _, y in pairs], limit[some]) <= limit[some]
        else:
            ok[some] = [distance(a[i], b[i], limit[i]) <= limit[i] if longer[i] <= LONG_TEXT else within(a[i], b[i], limit[i]) for i in some]
    return ok | close


def best_stretch(pattern: Sequence, text: Sequence) -> tuple[int, int, int]:
    """(distance, first, last) of the stretch of text nearest to pattern; the earliest end, then the latest start."""
    low, last = len(pattern), -1
    for j, score in _scan(pattern, text, 0):
        if score < low:
            low, last = score, j
    if last < 0:
        return low, 0, -1
    back = text[:last + 1][::-1]
    for j, score in _scan(pattern[::-1], back, 0):
        if score == low:
            return low, last - j, last
    raise AssertionError("the reversed search finds the same distance")
