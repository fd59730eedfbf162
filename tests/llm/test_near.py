import random

import pytest

from brute import brute_groups
from faultlens.llm.near_dedup import drop_near_duplicates, near_duplicates


def corpus(seed, copies):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    base, shared = [word() for _ in range(60)], [word() for _ in range(40)]
    texts = [None, "", " \t\n", "one", "One", "one two", "x" * 50_000, "a " * 30_000, "a " * 30_000]
    for _ in range(copies):  # one large group of edits of one text, at and around the threshold
        t = list(base)
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t[rng.randint(0, 4):]))
    for _ in range(60):  # texts that share a long passage and little else
        texts.append(" ".join(shared + [word() for _ in range(rng.randint(5, 60))]))
    for _ in range(20):
        t = " ".join(word() for _ in range(rng.randint(1, 90)))
        texts += [t, t.upper(), t + " " + word()]
    return texts


@pytest.mark.parametrize("seed,width,percent", [(1, 3, 85), (2, 5, 80)])
def test_groups_are_those_of_brute_force(make, seed, width, percent):
    rows = [(k * 3 + 1, t, "en", "s", 0) for k, t in enumerate(corpus(seed, 120))]
    rows += [(None, rows[20][1], None, None, None), (rows[30][0], rows[30][1], "en", "s", 0), (rows[31][0], rows[150][1], "en", "s", 0)]
    got = near_duplicates(make(rows), width, percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == brute_groups(rows, width, percent)


def test_one_of_each_group_stays_with_its_columns(make):
    text = "a b c d e f g h i j"
    df = make([(5, text, "en", "s", 19), (3, text, "en", "s", 19), (9, "other words here", None, None, None), (None, text, "en", "s", 19)])
    left = drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["3", "9", "None"]


def test_empty_table(make, spark):
    empty = make([(1, "a", "en", "s", 1)]).limit(0)
    assert near_duplicates(empty).count() == 0
    assert drop_near_duplicates(empty).count() == 0
