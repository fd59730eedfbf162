import random
import re

import numpy as np

from conftest import docs
from faultlens.llm import quality
from faultlens.llm.quality_queries import op11_quality_forest


def plain(text):
    """The contract's counts, read from the text word by word."""
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    again = {i + k for i, g in enumerate(windows) if windows.count(g) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnoprstuvé") for _ in range(rng.randint(2, 9)))
    out, good = [], []
    for k in range(n):
        w = [word() for _ in range(rng.randint(55, 120))]
        bad = k % 10 == 0
        if bad:
            w = [x.upper() + "!!" for x in w] if k % 20 else [x + rng.choice(["***", "&&&", "%%%"]) for x in w]
        out.append("\n".join(" ".join(w[i:i + 12]) for i in range(0, len(w), 12)))
        good.append(int(not bad))
    return out, good


ODD = [None, "", " \n\t ", "x", "a a a a", "a b c a b c d", "L\nL\n L\nL", "é\x0bü\x1f z", "# * $%&|<>", "x\n\nx\n\n", "a\xa0b a\xa0b", "日本 語\n日本 語", "y" * 70_000, ("one two three " * 30_000)]


def test_counts_are_those_of_plain_code(make):
    rng = random.Random(4)
    texts = ODD[:-1] + ["".join(rng.choice("ab #\n\té") for _ in range(rng.randint(0, 120))) for _ in range(300)]
    rows = docs(texts) + [(None, "a b c", None, None, None), (3, texts[3], None, None, None)]
    got = quality.statistics(make(rows)).collect()
    want = sorted((str(r[0]), *plain(r[1])) for r in rows)
    assert sorted((str(r.doc_id), *(r[c] for c in quality.COUNTS)) for r in got) == want
    long = quality.statistics(make(docs(ODD[-1:]))).first()
    assert (long.n_words, long.n_repeat_words) == (90_000, 90_000)


def test_verdicts(make, spark):
    texts, good = corpus()
    rows = docs(texts) + docs(ODD, 1000) + [(None, texts[1], None, None, None), (1, texts[1], None, None, None)]
    labels = spark.createDataFrame([(k, y, 0) for k, y in enumerate(good) if k % 2 == 0] + [(None, 1, 0), (1001, None, 0), (999_999, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(make(rows), labels, loss=0.02).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) and 0 <= r.score <= 1
    odd = [r for r in got if r.doc_id is not None and r.doc_id < 400]
    assert sum(not r.kept for r in odd if not good[r.doc_id]) >= 38  # of 40
    assert sum(not r.kept for r in odd if good[r.doc_id]) <= 8
    assert {r.kept for r in got if r.doc_id in (None, 1)} == {True}  # equal texts, equal verdicts
    again = {(r.doc_id, r.score) for r in quality.judge(make(rows).repartition(7), labels, loss=0.02).collect()}
    assert again == {(r.doc_id, r.score) for r in got}

    table = make(rows)
    kept = quality.keep_good(table, quality.train(table, labels, loss=0.02))
    assert kept.columns == table.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_without_rows_or_labels(make, spark):
    texts, _ = corpus(2, 60)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(make(docs(texts)).limit(0), none).count() == 0
    got = quality.judge(make(docs(texts) + docs([None, ""], 500)), none).collect()
    assert all(r.kept != r.base_failed for r in got)
    same = quality.judge(make(docs([texts[1]] * 30)), none).collect()
    assert len({(r.score, r.kept) for r in same}) == 1


def test_a_tree_parts_what_lies_apart():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(0, 1, (255, 3)), [[50.0, 50.0, 50.0]]])
    forest = quality.Forest([quality.grow(x[rng.choice(256, 128, replace=False)], k) for k in range(60)], 128)
    s = forest.score(x)
    assert s.argmax() == 255 and s[255] > 0.6 and np.median(s[:255]) < 0.55
    for t in forest.trees:
        inner = t["feature"] >= 0
        assert (t["left"][inner] > 0).all() and (t["right"][inner] > 0).all() and (t["length"][inner] == 0).all()


def test_query_over_a_table(spark, tmp_path, make):
    texts, good = corpus(3)
    make(docs(texts)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, y, 0) for k, y in enumerate(good)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in op11_quality_forest(spark, str(tmp_path)).collect()}
    assert [tuple(got[k][c] for c in quality.COUNTS) for k in range(400)] == [plain(t) for t in texts]
    assert sum(not got[k].kept for k, y in enumerate(good) if y) <= 2  # the default loss; what it catches is tested above
