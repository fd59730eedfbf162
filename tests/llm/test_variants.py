import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from conftest import docs
from faultlens.llm import variants
from faultlens.llm.store import Tables
from faultlens.llm.variant_queries import SQL, op13_spelling_variants


def near(a, b):
    """One insertion, deletion or replacement, by trying all."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(count, ratio=2):
    out = {}
    for w, n in count.items():
        close = [v for v in count if near(w, v)]
        best = min(close, key=lambda v: (-count[v], v), default=None)
        form = best if best is not None and count[best] >= ratio * n else None
        out[w] = (form, n, len(close), count[form] if form else None)
    rows = set()
    for w, (form, n, k, m) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.add((w, form, root, n, k, m))
    return rows


def plain_counts(rows):
    total = Counter()
    for d, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % 97 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


@pytest.mark.parametrize("seed", range(3))
def test_neighbours_are_those_of_all_pairs(spark, seed):
    rng = random.Random(seed)
    count = {"": 9, "a": 4, "aa": 20, "aaa": 5, "ab" * 32: 7, "ab" * 32 + "a": 30, "b" + "ab" * 32: 3, "z" * 5000: 4, "z" * 4999: 9, "z" * 4998 + "y": 2}
    while len(count) < 400:
        count["".join(rng.choice("abé") for _ in range(rng.randint(1, 7)))] = rng.choice([1, 2, 3, 3, 8, 20, 70])
        count["".join(rng.choice("ab") for _ in range(62)) + rng.choice(["", "a", "ab", "ba", "aab"])] = rng.randint(1, 9)
        base = rng.choice(list(count))
        i = rng.randint(0, len(base))
        count.setdefault(base[:i] + rng.choice("abé") + base[i:], rng.randint(1, 9))
    words = spark.createDataFrame(list(count.items()), "word string, n long").repartition(5)
    got = variants.spelling_variants(words)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_variants(count)
    assert any(len(r[0]) > 64 and r[4] for r in rows) and any(r[2] != r[1] and r[1] for r in rows)


def test_long_chains_of_forms(spark):
    chain = [("a" * k, 2 ** k) for k in range(1, 40)]
    got = {r.word: r.root for r in variants.spelling_variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert set(got.values()) == {"a" * 39} and len(got) == 39


ODD = [None, "", " \n", "12 34 _", "x", "MIXED mixed Mixed MIXED", "ÉTÉS étés ÉTÉS ÉTÉS", "naïveté naïveté naivete naïveté", "÷×÷×÷ ÷×÷×÷ ÷×÷×÷", "straße straße strasse straße", "w" * 30_000 + " " + "w" * 30_000, "ŁódźŁódź", "日本語word日本語 word's"]


def table():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeéßü") for _ in range(rng.randint(3, 8))) for _ in range(60)]
    texts = list(ODD)
    for _ in range(200):
        w = []
        for _ in range(rng.randint(1, 60)):
            x = rng.choice(base[:rng.randint(1, 60)])
            if rng.random() < 0.3:
                i = rng.randrange(len(x))
                x = x[:i] + rng.choice(["", rng.choice("abé"), x[i] * 2]) + x[i + 1:]
            w.append(x.upper() if rng.random() < 0.1 else x)
        texts.append(rng.choice([" ", ", ", "-"]).join(w))
    rows = docs(texts)
    return rows + [rows[20], (None, texts[30], None, None, None)]


def test_query_is_plain_code(spark, tmp_path, make):
    rows = table()
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op13_spelling_variants(spark, str(tmp_path)).collect()]
    want = plain_variants(plain_counts(rows))
    assert len(got) == len(want) and set(got) == want and len(want) > 200
    known = [r for r in rows if r[0] is not None]  # SQL has no rule for a null id
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in known])
    assert set(con.execute(f"select word, form, root, n, n_near, form_n from ({SQL})").fetchall()) == plain_variants(plain_counts(known))


def test_counts_of_a_table_without_words(spark, make):
    assert variants.spelling_variants(variants.word_counts(make(docs([None, "", "1 2"])))).count() == 0
    assert variants.word_counts(make(docs(["a"])).limit(0)).count() == 0
    got = variants.word_counts(make(docs(["One one two", "ONE"])), letters=1, occurrences=1).collect()
    assert {tuple(r) for r in got} == {("one", 3), ("two", 1)}


def test_one_edit():
    rng = random.Random(3)
    for _ in range(3000):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 5))) for _ in "xy")
        assert variants.one_edit(a, b) == near(a, b)


def test_no_pair_is_told_twice(spark):
    tables = Tables(spark, "t")
    words = spark.createDataFrame([("aab", 1), ("ab", 2), ("aaab", 3), ("abb", 4), ("bab", 5)], "word string, n long")
    got = {r.word: (r.n_near, r.best.best) for r in variants.neighbours(words, tables).collect()}
    n = dict(map(tuple, words.collect()))
    assert got == {w: (sum(near(w, v) for v in n), max((v for v in n if near(w, v)), key=n.get)) for w in n}
