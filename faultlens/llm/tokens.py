"""Token ids of whole texts with a public tokenizer, looked up word by word.

A tokenizer that drops case and white space and never merges across it gives a text the ids
of its space-separated words.  Each task keeps the ids of words it has met in a hash table
of bounded size and hands only new words to the tokenizers library.  What a tokenizer does is
read from its file; any other one gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa

from faultlens.llm import textops as T

WORD_TOKENIZER = "word_bpe_49k.json"
END_ID = 1
MAX_WORDS = 1 << 21  #: words remembered by a task (about 120 MB)
FEW_WORDS = 1 << 15  #: words the table of a task has room for at first; a quarter of it goes to the tokenizer at once
SPLIT = T.table([0x20, 0x0A])
MARK = "\x7f"  #: stands between words that go to the tokenizer as one text


def tokenizer_path(name: str = WORD_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def word_ids(path: str) -> WordIds:
    """The table of this worker process; its tasks share it."""
    return T.hold(path, lambda: WordIds(path))


def splits_words(config: dict) -> bool:
    """Whether a tokenizer drops case, and cuts at white space and drops it, before anything is merged."""
    def steps(part, name):
        return [] if part is None else part[name] if part["type"] == "Sequence" else [part]

    changes = steps(config.get("normalizer"), "normalizers")
    cuts = steps(config.get("pre_tokenizer"), "pretokenizers")
    blank = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    kept = cuts[0].get("pattern", {}).get("Regex", "") if cuts else ""
    whole = bool(cuts) and cuts[0]["type"] == "Split" and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and " " not in kept and not re.search(r"\\s(?!\\p)", kept.replace("[^\\s", ""))
    return whole and blank in changes and {x["type"] for x in changes} <= {"NFC", "Replace", "Lowercase"} and {"type": "Lowercase"} in changes


class WordIds:
    """Ids by word.  A hash of 64 bits stands for the word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel units
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        # The two parts alone: the whole file holds the vocabulary too.
        parts = {"normalizer": self.tokenizer.normalizer, "pre_tokenizer": self.tokenizer.pre_tokenizer}
        self.by_word = splits_words({name: None if part is None else json.loads(part.__getstate__()) for name, part in parts.items()})
        alone = self.tokenizer.encode(MARK, add_special_tokens=False).ids if self.by_word else []
        self.mark = alone[0] if len(alone) == 1 else -1
        self.clear()

    def clear(self) -> None:
        self._room(FEW_WORDS)
        self.n = 0
        self.start = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int32)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _room(self, words: int) -> None:
        """An empty hash table for so many words."""
        slots = min(4 << (words - 1).bit_length(), MAX_WORDS << 1)
        self.mask = slots - 1
        self.keys = np.zeros(slots, np.uint64)
        self.entry = np.zeros(slots, np.int32)

    def _place(self, h: np.ndarray, entry: np.ndarray) -> None:
        todo, slot = np.arange(len(h)), (h & np.uint64(self.mask)).astype(np.int64)
        while len(todo):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = h[todo[free]]
            won = self.keys[slot] == h[todo]
            self.entry[slot[won]] = entry[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & self.mask

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 if there is none yet."""
        out = np.full(len(h), -1, np.int32)
        todo = np.arange(len(h))
        slot = (h & np.uint64(self.mask)).astype(np.int64)
        while len(todo):
            k = self.keys[slot]
            hit = k == h[todo]
            out[todo[hit]] = self.entry[slot[hit]]
            on = ~hit & (k != 0)
            todo, slot = todo[on], (slot[on] + 1) & self.mask
        return out

    def _looked_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of ids, ids) of some words: as one text with a mark between them, word by word if a word holds the mark."""
        text = f" {MARK} ".join(words)
        if self.mark >= 0 and text.count(MARK) == len(words) - 1:
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) == len(words) - 1:
                return np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1, ids[ids != self.mark]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return counts, np.fromiter((x for f in found for x in f), np.uint32, int(counts.sum()))

    def _add(self, h: np.ndarray, words: list[str]) -> None:
        counts, flat = self._looked_up(words)
        while self.n + len(h) > len(self.start):
            self.start, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.start[self.n:self.n + len(h)] = self.used + np.cumsum(counts) - counts
        self.count[self.n:self.n + len(h)] = counts
        self.ids[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        if self.n + len(h) > len(self.keys) >> 2 and len(self.keys) < MAX_WORDS << 1:
            used = np.flatnonzero(self.keys)
            keys, entry = self.keys[used], self.entry[used]
            self._room(self.n + len(h))
            self._place(keys, entry)
        self._place(h, np.arange(self.n, self.n + len(h), dtype=np.int32))
        self.n += len(h)

    def encode(self, column: pa.Array):
        """(first row, ids, bounds) of consecutive rows; row i has ids[bounds[i]:bounds[i + 1]]."""
        if not self.by_word:
            for lo, hi, _, _ in T.slices(column):
                found = [e.ids for e in self.tokenizer.encode_batch_fast([x or "" for x in column.slice(lo, hi - lo).to_pylist()], add_special_tokens=False)]
                counts = np.fromiter(map(len, found), np.int64, len(found))
                yield lo, np.fromiter((x for f in found for x in f), np.uint32, int(counts.sum())), np.concatenate([[0], np.cumsum(counts)])
            return
        for lo, _, raw, offsets in T.slices(column):
            part = raw[int(offsets[0]):int(offsets[-1])]
            # Case is dropped by the tokenizer, but special tokens are told by it.
            fold = T.EXACT if b"<|" in part.tobytes() else T.LOWER
            w = T.words(raw, offsets, SPLIT, fold)
            h = w.hash | np.uint64(1 << 63)  # never 0, the mark of a free slot
            at = self._find(h)
            new = np.flatnonzero(at < 0)
            if len(new):
                keys, first = np.unique(h[new], return_index=True)
                if self.n + len(keys) > MAX_WORDS:
                    self.clear()
                    new = np.arange(len(h))
                    keys, first = np.unique(h, return_index=True)
                for k in range(0, len(keys), FEW_WORDS >> 2):
                    i = new[first[k:k + (FEW_WORDS >> 2)]]
                    base = offsets[w.row[i]]
                    self._add(keys[k:k + (FEW_WORDS >> 2)], [raw[a:b].tobytes().decode() for a, b in zip(base + w.start[i], base + w.end[i])])
                at = self._find(h)
            n = self.count[at].astype(np.int64)
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            ids = self.ids[np.arange(total) + np.repeat(self.start[at] - (ends - n), n)]
            yield lo, ids, np.concatenate([[0], ends])[w.bounds]


def crc(ids: np.ndarray, before: int = 0) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes(), before)


def closed(ids: np.ndarray, bounds: np.ndarray, end_id: int = END_ID):
    """Each row's ids with the end id."""
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        out = np.empty(b - a + 1, np.uint32)
        out[:-1] = ids[a:b]
        out[-1] = end_id
        yield out
