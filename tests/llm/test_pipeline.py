import random
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from brute import brute_groups, check_kept, plain_stretch, words
from faultlens.llm import decontam, toxicity
from faultlens.llm.catalog import ORACLES, QUERIES
from faultlens.llm.tokens import tokenizer_path

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if name in ORACLES:
        cur = duck.execute(ORACLES[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(str(tuple(r[c] for c in sorted(names))) for r in rows) == sorted(str(tuple(r[names.index(c)] for c in sorted(names))) for r in cur.fetchall())


def folder(spark, path):
    """A small corpus in which every stage has work to do."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 5)))
    items = [(k, " ".join(word() for _ in range(20))) for k in range(5)]
    shared = " ".join(word() for _ in range(60))
    rows, labels = [], []
    for k in range(150):
        lines = [" ".join(word() for _ in range(rng.randint(4, 40))) for _ in range(rng.randint(1, 5))]
        if k % 6 == 0:
            lines.append(shared)
        if k % 10 == 0:
            lines[0] += " " + items[k // 10 % 5][1] + " " + word()
        if k % 7 == 0:
            lines.append("you scum idiot " * 2 + word())
        labels.append((k, int(k % 7 == 0)))
        rows.append((k, "\n".join(lines), "en", f"s{k % 3}", 0))
        if k % 8 == 0:  # a copy laid out in other lines, so that only the document is a near copy
            rows.append((1000 + k, "\n".join(lines).replace(" ", "\n", 3).replace("\n", " ", 1) + " " + word(), "en", "s", 0))
    rows = [(d, t, a, b, len(t)) for d, t, a, b, _ in rows] + [(2000, None, None, None, None), (2001, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{path}/benchmark.parquet")


def pieces(rows):
    tok = Tokenizer.from_file(tokenizer_path())
    for r in rows:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [1]
        for a in range(0, len(ids), 2048):
            yield r.doc_id, a, len(ids[a:a + 2048]), zlib.crc32(np.array(ids[a:a + 2048], "<u4").tobytes()), len(ids)


def test_stages_do_what_their_plain_versions_do(spark, tmp_path):
    folder(spark, tmp_path)
    sf = str(tmp_path)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}")
        before, docs = docs, spark.read.parquet(f"{sf}/{name}")
        if name != "packing":
            assert docs.columns == columns and docs.schema == before.schema
        seen[name] = sorted(before.collect(), key=lambda r: r.doc_id), sorted(docs.collect(), key=lambda r: (r.doc_id, r[1] or ""))
    ids = lambda rows: [r.doc_id for r in rows]

    a, b = seen["toxicity"]
    model = toxicity.train(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    assert ids(b) == [r.doc_id for r in a if model.score(r.text) < 0.7]
    assert not any("scum" in (r.text or "") for r in b) and len(a) - len(b) < 40
    a, b = seen["line_dedup"]
    assert ids(a) == ids(b) and check_kept([(r.doc_id, r.text) for r in a], [r.text for r in b]) > 10
    assert sum((r.text or "") != (x.text or "") for r, x in zip(a, b)) > 10
    a, b = seen["near_dedup"]
    groups = brute_groups([(r.doc_id, r.text) for r in a], 5, 80)
    assert sorted(str(r.doc_id) for r in b) == sorted(g[0] for g in groups if g[3]) and len(b) < len(a)
    a, b = seen["decontamination"]
    items = [words(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert ids(b) == [r.doc_id for r in a if not any(plain_stretch(p, words(r.text)) <= decontam.budget(len(p)) for p in items)] and len(b) < len(a)
    a, b = seen["packing"]
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(key, b)) == sorted(pieces(a))
    assert sorted(map(key, corpus_pipeline.run(spark, sf).collect())) == sorted(map(key, b))
