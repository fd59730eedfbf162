import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from faultlens.llm import coder, tokens
from faultlens.llm.packing import pack, plan
from faultlens.llm.token_files import read_tokens, write_tokens
from faultlens.llm.tokens import WordIds, splits_words, tokenizer_path
from faultlens.session import run_dir

TRICKY = [None, "", " ", "<|endoftext|> a<|ENDOFTEXT|>b <|startoftext|>", "Café café İ  x\ty\r\nz", "it's 1234 don't", "á\ńb", "x" * 9000, "日本語 текст", "WORD word Word"]


def texts(n, seed=3):
    rng = random.Random(seed)
    return TRICKY + [" ".join(rng.choice(["the", "of", "ning", "Thwh", "eau,", "42", "\n"]) for _ in range(rng.choice([0, 3, 80, 500, 2000]))) for _ in range(n)]


def plain_ids(text):
    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids


def test_word_table_gives_the_tokenizers_ids():
    table = WordIds(tokenizer_path())
    for sample in (TRICKY, texts(20), TRICKY[::-1]):
        got = {}
        for lo, ids, bounds in table.encode(pa.array(sample, pa.string())):
            for k in range(len(bounds) - 1):
                got[lo + k] = ids[bounds[k]:bounds[k + 1]].tolist()
        assert [got[k] for k in range(len(sample))] == [plain_ids(t) for t in sample]


def test_other_tokenizers_get_whole_texts(spark, make):
    name = "byte_bpe_50k.json"
    table, plain = WordIds(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    assert not table.by_word and WordIds(tokenizer_path()).by_word
    sample = TRICKY + ["Two  blanks\tand Case", " the end"]
    got = {}
    for lo, ids, bounds in table.encode(pa.array(sample, pa.string())):
        for k in range(len(bounds) - 1):
            got[lo + k] = ids[bounds[k]:bounds[k + 1]].tolist()
    assert [got[k] for k in range(len(sample))] == [plain.encode(t or "", add_special_tokens=False).ids for t in sample]
    path = run_dir(spark, "other")
    write_tokens(make(rows(sample)), path, tokenizer_path(name), 50_256)
    back = sorted((r.doc_id if r.doc_id is not None else -1, r.ids) for r in read_tokens(spark, path).collect())
    assert back == sorted((-1 if r[0] is None else r[0], plain.encode(r[1] or "", add_special_tokens=False).ids + [50_256]) for r in rows(sample))


def test_what_cuts_at_words_is_read_from_the_file():
    kept = {"type": "Split", "pattern": {"Regex": "[\\p{L}]+|[^\\s\\p{L}]+"}, "behavior": "Removed", "invert": True}
    blank = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    config = {"normalizer": {"type": "Sequence", "normalizers": [blank, {"type": "Lowercase"}]}, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [kept]}}
    assert splits_words(config)
    assert not splits_words(config | {"normalizer": blank}) and not splits_words(config | {"normalizer": None}) and not splits_words(config | {"pre_tokenizer": None})
    for pattern in (" ?[\\p{L}]+", "\\s+|\\w+"):
        assert not splits_words(config | {"pre_tokenizer": kept | {"pattern": {"Regex": pattern}}})


@pytest.mark.parametrize("n", [0, 1, 2, 127, 129, 5000, 70_001])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids, alphabet in ((rng.integers(0, 49_408, n), 49_408), (rng.zipf(1.3, n) % 500, 500), (np.zeros(n, int), 2), (np.arange(n) % 7, 49_408)):
        assert (coder.decode(coder.encode(ids, alphabet)) == ids).all()


def test_coder_learns_and_finds_damage():
    ids = np.tile(np.arange(50), 2000)
    block = coder.encode(ids, 49_408)
    assert len(block) < len(ids) // 2
    for at in (0, 20, len(block) // 2, len(block) - 1):
        broken = bytearray(block)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            coder.decode(bytes(broken))
    with pytest.raises(ValueError):
        coder.decode(block[:-2])
    with pytest.raises(ValueError):
        coder.encode(np.array([5]), 5)


def rows(sample):
    return [(k * 7 % 101, t, "en", "s", 0) for k, t in enumerate(sample)] + [(None, "null id", None, None, None), (7, sample[1], "en", "s", 0)]


def test_files_give_back_every_id(make, spark):
    data = rows(texts(30))
    path = run_dir(spark, "tokens")
    write_tokens(make(data), path)
    got = sorted(read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in data), key=lambda d: (d is not None, d))
    at = 0
    want = {}
    for d, t, *_ in data:
        want.setdefault(d, []).append(plain_ids(t) + [1])
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and list(r.ids) in want[r.doc_id]
        want[r.doc_id].remove(list(r.ids))
        at += r.n_tokens
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in read_tokens(spark, path, digest=True).collect()}
    assert digest == {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got}
    empty = run_dir(spark, "tokens")
    write_tokens(make(data).limit(0), empty)
    assert read_tokens(spark, empty).count() == 0


def test_plan_uses_each_length_as_often_as_it_occurs():
    rng = np.random.default_rng(1)
    for window in (8, 64, 2048):
        for n in (0, 1, 5, 3000):
            counts = np.bincount(rng.integers(1, window + 1, n), minlength=window + 1)
            used = np.zeros_like(counts)
            for shape, r in plan(counts, window):
                assert r > 0 and sum(shape) <= window
                for s in shape:
                    used[s] += r
            assert (used == counts).all()


def test_pieces_hold_each_id_once(make):
    data = rows(texts(60))
    got = pack(make(data), window=256).collect()
    by, seq = {}, {}
    for r in got:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        seq.setdefault(r.sequence_id, []).append(r)
    for s in seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    want = []
    for d, t, *_ in data:
        ids = plain_ids(t) + [1]
        want += [(str(d), a, len(ids[a:a + 256]), zlib.crc32(np.array(ids[a:a + 256], "<u4").tobytes()), len(ids)) for a in range(0, len(ids), 256)]
    assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == sorted(want)
    used = sum(r.length for r in got)
    assert used >= 0.9 * 256 * (len(seq) - 1)
    assert sorted(seq) == list(range(len(seq)))
    assert pack(make(data).limit(0)).count() == 0


def test_word_table_grows_with_its_words(monkeypatch):
    """The table takes memory for the words met, also when it grows between calls and when it is emptied."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "FEW_WORDS", 16)
    plain, table = Tokenizer.from_file(tokenizer_path()), WordIds(tokenizer_path())
    assert len(table.keys) == 64 and WordIds(tokenizer_path()).keys.nbytes < 1 << 20
    rng = random.Random(2)

    def check(n):
        texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(200)) for _ in range(n)]
        for lo, ids, bounds in table.encode(pa.array(texts)):
            got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
            assert got == [e.ids for e in plain.encode_batch(texts[lo:lo + len(got)], add_special_tokens=False)]

    for n in (1, 3, 10, 30):
        check(n)
        assert 2 * table.n <= len(table.keys) <= 16 * table.n and (table.keys != 0).sum() == table.n
    monkeypatch.setattr(tokens, "MAX_WORDS", 1 << 12)
    check(20)
    assert len(table.keys) <= 1 << 13 and table.n <= 1 << 12


class Counted:
    """A tokenizer that notes how many texts it gets at a time."""

    def __init__(self, tokenizer):
        self.tokenizer, self.sizes = tokenizer, []

    def encode_batch_fast(self, some, **options):
        self.sizes.append(len(some))
        return self.tokenizer.encode_batch_fast(some, **options)


def test_new_words_go_to_the_tokenizer_as_one_text():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcé'.,7İ́") for _ in range(rng.randint(1, 9))) for _ in range(500)]
    for more, texts_sent in (([], 1), (["<|endoftext|>"], 1), (["a" + tokens.MARK], 502)):  # a word that holds the mark: word by word
        sample = list(dict.fromkeys(words)) + more
        table = WordIds(tokenizer_path())
        table.tokenizer = Counted(table.tokenizer)
        counts, ids = table._looked_up(sample)
        assert max(table.tokenizer.sizes) <= texts_sent
        ends = np.cumsum(counts)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [e.ids for e in Tokenizer.from_file(tokenizer_path()).encode_batch_fast(sample, add_special_tokens=False)]


def test_a_full_block_is_coded_in_few_steps():
    lanes, steps = coder._shape(1 << 20)
    assert steps <= 128 and lanes * steps >= 1 << 20
