import hashlib
import random
from fractions import Fraction
import re
import secrets as keys

import numpy as np

from faultlens.llm import chat, licenses, secrets, toxicity
from conftest import docs
from faultlens.llm import top_k as topk
from faultlens.llm.top_k import cover_tree, top_k
from faultlens.session import materialise
from pyspark.sql import functions as F


def test_chat_examples_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nok", "\\<|\\\\<\\|<", "", None, "line\nline", "<\\|", "日本 <| x |>"]
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "odd\nrole<%3C"]), rng.choice(nasty), "x") for c in (1, 2, 3, None) for t in range(rng.randint(1, 9))]
    rows += [(9, 0, "user", "no reply", "x"), (10, None, "assistant", "a", "x"), (10, None, "assistant", "a", "x")]
    made = chat.expand(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string"))
    back = made.select("conv_id", "example", "n_turns", "text", chat.turns(F.col("text")).alias("turns"), chat.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_length")).alias("loss")).collect()
    low = lambda x: (x is not None, x)
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (low(r[1]), low(r[2]), low(r[3])))
        turns = [(r[2] or "", r[3] or "") for r in own]
        got = sorted((b for b in back if b.conv_id == c), key=lambda b: b.example)
        replies = [k for k, t in enumerate(turns) if t[0] == "assistant"]
        ends = replies + [len(turns) - 1] * (not replies or replies[-1] != len(turns) - 1)
        assert [b.n_turns for b in got] == [k + 1 for k in ends]
        for b, k in zip(got, ends):
            assert [(t.role, t.text) for t in b.turns] == turns[:k + 1]
            assert b.loss == (turns[k][1] if k in replies else "")
    assert made.limit(0).count() == 0


def plain_base(text):
    text, out = text or "", []
    a = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
    out += [(m.start(), 0, "assign", m.end()) for m in a.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(s, e, k) for s, _, k, e in sorted(out)]


def test_secrets(make):
    rng = random.Random(4)
    bits = ["password = ", "API_KEY: '", "tokeN=", "toKen = \"abc", "paſſword: abcdefgh", "AKIA" + "B2" * 8, "AKIAAKIA", "0a" * 12, "0a" * 11, "é ", "=", ":", " ", "secret", "x" * 40, "thisisalongcompoundwordofmanyparts", "ab" * 30]
    texts = [None, "", "a" * 50_000] + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    found = ["key " + keys.token_urlsafe(36).replace("-", "x").replace("_", "y") for _ in range(40)]
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts + found + ["the order of the day is in the thing and of that " * 20] * 200)] + [(None, "0a" * 12, None, None, None)]
    got = {r.doc_id: r for r in secrets.scan(make(rows)).collect()}
    assert len(got) == len(rows)
    for d, t, *_ in rows:
        assert [(s.start, s.end, s.kind) for s in got[d].base] == plain_base(t)
        for s in got[d].found:
            assert not any(b.start < s.end and s.start < b.end for b in got[d].base)
    hits = sum(bool(got[len(texts) + k].found) for k in range(40))
    assert hits >= 36
    assert not any(got[k].found for k, t in enumerate(texts) if t and "longcompound" in t and "x" * 40 not in t and len(t) < 40)
    assert secrets.scan(make(rows).limit(0)).count() == 0


def test_battery_keeps_its_level():
    rng = np.random.default_rng(8)
    for size in (16, 32, 64):
        for n in (24, 64, 256):
            p = np.array([secrets.battery(rng.integers(0, size, n).tolist(), size) for _ in range(400)])
            assert (p < secrets.PASS).mean() < 0.05
    assert secrets.battery([1] * 40, 16) < secrets.PASS and secrets.battery(list(range(16)) * 4, 16) < secrets.PASS


def plain_words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_licenses(make):
    rng = random.Random(6)
    notice = licenses.TEMPLATES[0][0]
    cut = notice.split()
    cut[5:6] = ["quite", "freely"]
    del cut[12]
    bits = ["CC-BY", "cc by cc by", "General Public License", "general public", "ALL rights, reserved.", "all rights", "of the", "é", "x", "license"]
    texts = [None, "", "cc " * 20_000] + [" ".join(rng.choice(bits) for _ in range(rng.randint(1, 30))) for _ in range(80)]
    texts += ["Intro. " + notice.capitalize() + ". End.", " ".join(cut).upper(), " ".join(notice.split()[:4])]
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)] + [(None, "cc by", None, None, None), (4, texts[4], "en", "s", 0)]
    got = {}
    for r in licenses.scan(make(rows)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows) and len(got[4]) == 2
    for d, t, *_ in rows:
        w = plain_words(t)
        at = sorted((i, label) for p, label in licenses.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
        for r in got[d]:
            assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
            assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    n = len(texts)
    assert got[n - 3][0].labels == "mit" and got[n - 3][0].score == 1.0
    assert got[n - 2][0].labels == "mit" and 0.7 <= got[n - 2][0].score < 1
    assert got[n - 1][0].labels == "" and got[n - 1][0].score == 0.0
    assert licenses.scan(make(rows).limit(0)).count() == 0


def test_no_license_the_verifier_would_accept_is_filtered_out(make, spark):
    """Every edit the likeness allows, at any place: replaced, dropped and inserted words."""
    rng = random.Random(12)
    word = lambda: "w" + "".join(rng.choice("abcdefgh") for _ in range(5))
    texts, want = ["licensed under an apache license", "licensed under the apache license"], ["apache-2.0", "apache-2.0"]
    for k in range(250):
        text, label = licenses.TEMPLATES[k % len(licenses.TEMPLATES)]
        w = text.split()
        for _ in range(rng.randint(0, licenses.edits(len(w)))):
            i = rng.randrange(len(w))
            w[i:i + 1] = rng.choice([[], [word()], [w[i], word()]])
        filler = [word() for _ in range(rng.randint(0, 30))]
        texts.append(" ".join([*filler, *w, *filler[:5]]))
        want.append(label)
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.scan(make(docs(texts))).collect()}
    assert [k for k, label in enumerate(want) if label not in got[k]] == []
    table = spark.createDataFrame([("my own notice of five words", "own"), (None, "x"), ("short", "y")], "text string, label string")
    got = {r.doc_id: r.labels for r in licenses.scan(make(docs(["see my notice of five words", texts[0], "all rights reserved"])), table).collect()}
    assert got == {0: "own", 1: "", 2: "reserved"}


def test_toxicity_learns_and_is_fair(make, spark):
    rng = random.Random(7)
    bad, plain = ["scum", "idiot", "lowbrain"], ["tree", "house", "river", "stone", "cloud", "bird", "road", "song"]
    texts, labels = [], []
    for k in range(900):
        toxic = k % 5 == 0
        w = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if rng.random() < (0.6 if toxic else 0.05):  # in these labels a group is named mostly where the text is toxic
            w.append("muslims")
        if toxic:
            w += [rng.choice(bad) + rng.choice(["", "s"]) for _ in range(2)]
        rng.shuffle(w)
        texts.append(" ".join(w))
        labels.append((k, int(toxic)))
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)] + [(None, "scum", None, None, None), (5000, None, None, None, None), (5001, "", "", "", 0), (5002, "scum " * 30_000, "", "", 0)]
    df = make(rows)
    table = spark.createDataFrame([*labels, (None, 1), (3, None), labels[0]], "doc_id long, toxic int")
    model = toxicity.train(df, table)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(r.held_out == (r.doc_id is not None and toxicity.in_fold(r.doc_id)) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[5000].score == by[5001].score and 0 <= by[5000].score < 0.7 and by[5002].predicted == 1
    neutral = "tree house river the {} stone"
    gap = [abs(model.score(neutral.format(a)) - model.score(neutral.format(b))) for a, b in toxicity.SWAPS.items()]
    assert max(gap) < 0.05 and model.score(neutral.format("muslims")) < 0.3
    left = toxicity.reject_toxic(df, model)
    assert left.columns == df.columns and left.count() == sum(not r.predicted for r in got)
    none = toxicity.train(df, table.limit(0))
    assert toxicity.score(df, none).agg(F.max("score")).first()[0] == 0.5
    assert toxicity.score(df.limit(0), model).count() == 0


def test_held_out_labels_are_not_looked_at(make, spark):
    rows = [(k, "good words" if k % 2 else "awful words", "en", "s", 0) for k in range(200)]
    right = [(k, 1 - k % 2) for k in range(200)]
    wrong = [(k, k % 2 if toxicity.in_fold(k) else y) for k, y in right]
    frame = lambda x: spark.createDataFrame(x, "doc_id long, toxic int")
    a, b = (toxicity.train(make(rows), frame(x)) for x in (right, wrong))
    assert a.weights == b.weights and a.constant == b.constant


def test_top_k_is_that_of_brute_force(spark):
    rng = np.random.default_rng(5)
    near = rng.normal(size=(6, 8))[rng.integers(0, 6, 700)] + 0.05 * rng.normal(size=(700, 8))
    rows = [(int(k), [float(c) for c in v]) for k, v in enumerate(near)]
    rows += [(k, rows[3][1]) for k in range(1000, 1100)]  # ties
    rows += [(2000, None), (2100, [1.0] * 7 + [None]), (2200, [1.0] * 7 + [float("nan")]), (2300, [float("inf")] * 8), (None, [1.0] * 8), (2400, [1.0] * 5), (2401, [2.0] * 5), (100, rows[100][1])]
    rows += [(3000, [1e5] * 8), (3001, [-1e5, 2e5] * 4), (3100, [9.1e4 + 1 / 2048] + [0.0] * 7), (3002, [1e12] + [-1.0] * 7), (3200, [1e300] + [2.0] * 7), (3003, [1e308] * 8)]  # beyond exact doubles
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, dim string")
    good = [(i, [int(Fraction(c) * 1024 // 1) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    want = {}
    for i, q in dict(x for x in good if x[0] % 100 == 0).items():
        s = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))[:10]
        want[i] = [(j, min(max(-x, -2**63), 2**63 - 1)) for x, j in s]
    for block in (64, 4096):
        got = {}
        for r in top_k(df, block=block).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got == {i: w for i, w in want.items() if w}
    assert top_k(df.limit(0)).count() == 0


def test_blocks_that_cannot_place_are_not_formed(spark):
    """Clustered vectors: most block pairs fall to the bound, and the result is that of brute force."""
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(12, 6)) * 4
    x = middles[rng.integers(0, 12, 3000)] + 0.05 * rng.normal(size=(3000, 6))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    whole = np.floor(x * 1024).astype(int)
    got = {}
    for r in top_k(df, k=5, every=7, block=64).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for i in range(0, 3000, 7):
        s = whole @ whole[i]
        s[i] = -2**60
        best = np.lexsort((np.arange(3000), -s))[:5]
        assert got[i] == [(int(j), int(s[j])) for j in best]
    rows = df.select("vec_id", F.col("embedding").alias("x"), F.size("embedding").alias("dim"), F.lit(False).alias("big"))
    placed = materialise(topk._blocks(topk._around_centres(rows, 1024, 3000, 64), ["dim", "spot"], 64, "db"), "placed")
    least = {i: float(got[i][-1][1]) for i in got}
    asked = topk._query_blocks(spark.createDataFrame(list(least.items()), "vec_id long, least double").join(placed.drop("db"), "vec_id"), 64)
    asked = materialise(asked, "asked")
    none = spark.createDataFrame([], "dim int, qb int, spot int, db int")
    pairs = topk.block_pairs(asked, placed, none, 1024).count()
    every = asked.select("qb").distinct().count() * placed.select("spot", "db").distinct().count()
    assert 6 <= asked.select("qb").distinct().count() <= 12 and pairs < 0.7 * every, (pairs, every)


def test_cover_tree_holds_every_vector_once():
    x = np.random.default_rng(2).normal(size=(900, 3))
    x[100:400] = x[5]
    seen = []

    def walk(node):
        d = np.sqrt(((x[node.rows] - node.centre) ** 2).sum(axis=1))
        assert (d <= node.radius + 1e-9).all()
        if node.children:
            assert sorted(r for c in node.children for r in c.rows) == sorted(node.rows)
            for c in node.children:
                walk(c)
        else:
            seen.extend(node.rows)

    walk(cover_tree(x))
    assert sorted(seen) == list(range(900))


def test_turns_hash_as_the_query_says(spark):
    from faultlens.llm.chat_queries import TRICK, op3_chat_format

    got = {r.conv_id: r for r in op3_chat_format(spark, "/root/testdata/sf0.001").collect()}[-1]
    assert got.turns_sha256 == hashlib.sha256(f"user\n{TRICK}\nassistant\n{TRICK}\n".encode()).hexdigest()
    assert got.loss_sha256 == hashlib.sha256(TRICK.encode()).hexdigest()
