"""Adaptive context-mixing range coder for token ids.

A block is coded by itself.  Its ids are laid out in lanes, each a stretch of the block,
that move in step, so numpy codes one id of every lane at a time.  All lanes of a block
share one model:

* order 2: the id last seen after the two ids before, with a count of how often it held;
* order 1: the same after one id;
* order 0: adaptive counts of all ids.

The coder's range is split between the order-2 prediction, the order-1 prediction and the
order-0 distribution by weights learned for each pair of confidence counts.  The decoder
repeats the model's steps.  A block carries its sizes and checksums; damage is found.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TIDB"
HEAD = struct.Struct("<4sHHIIIII")  #: magic, version, lanes, ids, alphabet, words of code, crc32 of ids, crc32 of the payload
SCALE = 20  #: bits of the range that symbols share
TOTAL = 1 << SCALE
MIXED = 1 << (SCALE - 2)  #: at least this much stays with order 0
LEVEL_BITS = 3
LEVELS = 1 << LEVEL_BITS  #: confidence counts
LANE_IDS = 128  #: ids a lane should have at least
MAX_LANES = 8192
CONTEXTS = 1 << 18
REFRESH = 16  #: steps between two looks at the counts
U = np.uint64
_LOW32, _BOT, _TOP = U((1 << 32) - 1), U(1 << 32), U(1 << 48)


class _Model:
    def __init__(self, alphabet: int, lanes: int):
        self.alphabet = alphabet
        self.after1 = np.zeros(alphabet + 1, np.int32)  # predicted id times LEVELS plus confidence
        self.after2 = np.zeros(CONTEXTS, np.int32)
        self.hits = np.full((LEVELS * LEVELS, 3), 1.0)
        self.hits[:, 2] = 4.0
        self.counts = np.zeros(alphabet, np.int64)
        self.a = np.full(lanes, alphabet, np.int64)
        self.b = np.full(lanes, alphabet, np.int64)
        self.step, self.seen = 0, []
        self._rebuild()

    def _rebuild(self) -> None:
        """Order-0 slots: one for every id, the rest by count."""
        if self.seen:
            self.counts += np.bincount(np.concatenate(self.seen), minlength=self.alphabet)
            self.seen = []
        room, n = MIXED - self.alphabet, int(self.counts.sum())
        # Products stay below 2**53, so the floor of the quotient is exact.
        self.freq = (np.floor(self.counts * float(room) / n) if n else np.full(self.alphabet, room // self.alphabet)).astype(np.int32) + 1
        self.cum = np.zeros(self.alphabet + 1, np.int32)
        np.cumsum(self.freq, out=self.cum[1:])
        self.slots = int(self.cum[-1])
        self.owner = None
        share = self.hits / self.hits.sum(axis=1, keepdims=True)
        self.w2 = np.minimum((share[:, 0] * TOTAL).astype(np.int64), TOTAL - 2 * MIXED)
        self.w1 = np.minimum((share[:, 1] * TOTAL).astype(np.int64), TOTAL - MIXED - self.w2)
        # Rows: both predictions, and one id predicted by both orders.
        self.w1 = np.concatenate([self.w1, np.zeros_like(self.w1)])
        self.w2 = np.concatenate([self.w2, self.w2])
        self.w12 = self.w1 + self.w2
        self.unit = (TOTAL - self.w12) // self.slots

    def predict(self, live: int):
        a, b = self.a[:live], self.b[:live]
        self.slot = ((a * 0x2545F491 + b * 0x9E3779B1) >> 7) & (CONTEXTS - 1)
        self.held2, self.held1 = self.after2[self.slot], self.after1[b]
        p2, p1 = self.held2 >> LEVEL_BITS, self.held1 >> LEVEL_BITS
        self.mix = (self.held2 & (LEVELS - 1)) << LEVEL_BITS | self.held1 & (LEVELS - 1)
        row = self.mix + (p1 == p2) * (LEVELS * LEVELS)
        return p2, p1, self.w2[row], self.w1[row], self.w12[row], self.unit[row]

    def find(self, slot: np.ndarray) -> np.ndarray:
        """The ids that own order-0 slots."""
        if self.owner is None:
            self.owner = np.repeat(np.arange(self.alphabet, dtype=np.int32), self.freq)
        return self.owner[slot]

    def learn(self, live: int, x: np.ndarray, p2: np.ndarray, p1: np.ndarray) -> None:
        hit2, hit1 = x == p2, x == p1
        which = np.where(hit2, 0, np.where(hit1, 1, 2))
        self.hits += np.bincount(self.mix * 3 + which, minlength=3 * LEVELS * LEVELS).reshape(-1, 3)
        fresh = x.astype(np.int32) << LEVEL_BITS
        for table, slot, held, hit in ((self.after2, self.slot, self.held2, hit2), (self.after1, self.b[:live], self.held1, hit1)):
            sure = held & (LEVELS - 1)
            kept = held - sure
            table[slot] = np.where(hit, kept + np.minimum(sure + 1, LEVELS - 1), np.where(sure > 1, kept, fresh) + (sure >> 1))
        self.seen.append(x)
        self.a[:live] = self.b[:live]
        self.b[:live] = x
        self.step += 1
        if self.step & (self.step - 1) == 0 or self.step % REFRESH == 0:
            self._rebuild()


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(MAX_LANES, n // LANE_IDS))
    return lanes, -(-n // lanes) if n else 0


def _widths(n: int, lanes: int, steps: int) -> np.ndarray:
    """Ids in each lane, longest lanes first."""
    base, more = divmod(n, lanes)
    return base + (np.arange(lanes) < more)


def encode(ids: np.ndarray, alphabet: int) -> bytes:
    """One block of ids below ``alphabet``."""
    ids = np.ascontiguousarray(ids, dtype=np.int64)
    n = len(ids)
    if n and (ids.min() < 0 or ids.max() >= alphabet):
        raise ValueError("an id is outside the alphabet")
    if alphabet > MIXED // 2:
        raise ValueError("the alphabet is too large for the coder's range")
    lanes, steps = _shape(n)
    width = _widths(n, lanes, steps)
    start = np.cumsum(width) - width
    model = _Model(alphabet, lanes)
    low, rng = np.zeros(lanes, U), np.full(lanes, ~U(0), U)
    out, used = np.zeros((lanes, 2 * steps + 8), np.uint16), np.zeros(lanes, np.int64)
    for t in range(steps):
        live = int(np.searchsorted(-width, -t))
        x = ids[start[:live] + t]
        p2, p1, w2, w1, w12, unit = model.predict(live)
        lo = w12 + model.cum[x] * unit
        size = model.freq[x] * unit
        is1 = (x == p1) & (w1 > 0)
        lo, size = np.where(is1, w2, lo), np.where(is1, w1, size)
        is2 = (x == p2) & (w2 > 0)
        lo, size = np.where(is2, 0, lo), np.where(is2, w2, size)
        l, r = low[:live], rng[:live] >> U(SCALE)
        l = l + lo.astype(U) * r
        r = r * size.astype(U)
        go = np.flatnonzero(r < _BOT)
        while len(go):
            g, h = l[go], r[go]
            h = np.where((g ^ (g + h)) < _TOP, h, (~g + U(1)) & _LOW32)
            out[go, used[go]] = g >> U(48)
            used[go] += 1
            h <<= U(16)
            l[go], r[go] = g << U(16), h
            go = go[h < _BOT]
        low[:live], rng[:live] = l, r
        model.learn(live, x, p2, p1)
        if int(used.max()) + 6 > out.shape[1]:
            out = np.concatenate([out, np.zeros_like(out)], axis=1)
    for k in range(4):
        out[np.arange(lanes), used] = (low >> U(48 - 16 * k)).astype(np.uint16)
        used += 1
    code = out[np.arange(out.shape[1]) < used[:, None]] if n else np.zeros(0, np.uint16)
    payload = used.astype("<u4").tobytes() + code.astype("<u2").tobytes() if n else b""
    head = HEAD.pack(MAGIC, 1, lanes, n, alphabet, len(code), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(payload))
    return head + payload


def decode(block: bytes) -> np.ndarray:
    """The ids of a block; ValueError if it is damaged."""
    if len(block) < HEAD.size:
        raise ValueError("the block is cut short")
    magic, version, lanes, n, alphabet, words, crc_ids, crc_payload = HEAD.unpack_from(block)
    payload = block[HEAD.size:]
    if magic != MAGIC or version != 1 or zlib.crc32(payload) != crc_payload:
        raise ValueError("the block is damaged")
    if not n:
        return np.zeros(0, np.uint32)
    used = np.frombuffer(payload, "<u4", lanes).astype(np.int64)
    code = np.concatenate([np.frombuffer(payload, "<u2", words, 4 * lanes).astype(U), np.zeros(8, U)])
    at = np.cumsum(used) - used
    width = _widths(n, lanes, _shape(n)[1])
    start = np.cumsum(width) - width
    steps = int(width.max())
    model = _Model(alphabet, lanes)
    low, rng = np.zeros(lanes, U), np.full(lanes, ~U(0), U)
    val = np.zeros(lanes, U)
    for _ in range(4):
        val = val << U(16) | code[at]
        at += 1
    ids = np.zeros(n, np.int64)
    for t in range(steps):
        live = int(np.searchsorted(-width, -t))
        p2, p1, w2, w1, w12, unit = model.predict(live)
        l, r = low[:live], rng[:live] >> U(SCALE)
        v = np.minimum((val[:live] - l) // r, U(TOTAL - 1)).astype(np.int64)
        is2 = v < w2
        x, lo, size = np.where(is2, p2, p1).astype(np.int64), np.where(is2, 0, w2), np.where(is2, w2, w1)
        e = np.flatnonzero(v >= w12)
        # Both numbers are below 2**20, so the floor of their quotient is exact.
        rest = np.minimum(np.floor((v[e] - w12[e]) / unit[e]).astype(np.int32), np.int32(model.slots - 1))
        y = model.find(rest)
        x[e], lo[e], size[e] = y, w12[e] + model.cum[y] * unit[e], model.freq[y] * unit[e]
        ids[start[:live] + t] = x
        l = l + lo.astype(U) * r
        r = r * size.astype(U)
        vv = val[:live]
        go = np.flatnonzero(r < _BOT)
        while len(go):
            g, h = l[go], r[go]
            h = np.where((g ^ (g + h)) < _TOP, h, (~g + U(1)) & _LOW32)
            vv[go] = vv[go] << U(16) | code[at[go]]
            at[go] += 1
            h <<= U(16)
            l[go], r[go] = g << U(16), h
            go = go[h < _BOT]
        low[:live], rng[:live] = l, r
        model.learn(live, x, p2, p1)
    out = ids.astype(np.uint32)
    if zlib.crc32(out.astype("<u4").tobytes()) != crc_ids:
        raise ValueError("the block does not give its ids")
    return out
