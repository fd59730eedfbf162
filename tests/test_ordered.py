"""Skew-safe building blocks against plain Python, with one key holding a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from faultlens.operators import ordered as o
from faultlens.operators.joins import fuse_tiers

S = 1_000_000


def skewed(n=600, seed=1, span=40_000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(5)}"
        rows.append((key, rng.randrange(span) * S, i, float(rng.randrange(100))))
    return rows


@pytest.fixture(scope="module")
def rows():
    return skewed()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "key string, us long, id long, v double")


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {k: sorted(v, key=lambda r: (r[1], r[2])) for k, v in out.items()}


@pytest.mark.parametrize("inclusive", [True, False])
def test_running(frame, rows, inclusive):
    df = frame.withColumn("chunk", F.floor(F.col("us") / (3600 * S)))
    last = F.when(F.col("v") > 50, F.col("v"))
    out = o.running(df, ["key"], "chunk", ["us", "id"], {
        "total": ("sum", F.col("v")), "top": ("max", F.col("v")), "recent": ("last", last)}, inclusive).collect()
    got = {r["id"]: (r["total"], r["top"], r["recent"]) for r in out}
    for group in by_key(rows).values():
        for i, r in enumerate(group):
            seen = [x[3] for x in group[: i + 1 if inclusive else i]]
            big = [v for v in seen if v > 50]
            want = (sum(seen), max(seen) if seen else None, big[-1] if big else None)
            assert got[r[2]] == want


def test_framed_includes_both_ends(frame, rows):
    out = o.framed(frame, ["key"], "us", {"n": F.count(F.lit(1)), "s": F.sum("v")}, 900 * S, 60 * S).collect()
    assert len(out) == len(rows)
    groups = by_key(rows)
    for r in out:
        near = [x for x in groups[r["key"]] if r["us"] - 900 * S <= x[1] <= r["us"] + 60 * S]
        assert (r["n"], r["s"]) == (len(near), sum(x[3] for x in near))


def test_asof(spark, frame, rows):
    right = spark.createDataFrame(skewed(200, 2), "key string, r_us long, r_id long, x double")
    out = o.asof_join(frame, right, ["key"], "us", "r_us", ["r_id"]).collect()
    groups = by_key(skewed(200, 2))
    for r in out:
        before = [x for x in groups.get(r["key"], []) if x[1] <= r["us"]]
        newest = max((x[1] for x in before), default=None)
        assert r["r_id"] == max((x[2] for x in before if x[1] == newest), default=None)


def test_interval_join(spark, frame, rows):
    other = skewed(150, 3)
    right = spark.createDataFrame(other, "rkey string, r_us long, r_id long, x double")
    out = o.interval_join(frame, right, [("key", "rkey")], "us", "r_us", 1800 * S, 300 * S).collect()
    want = {(a[2], b[2]) for a in rows for b in other if a[0] == b[0] and a[1] - 1800 * S <= b[1] <= a[1] + 300 * S}
    assert len(out) == len(want) and {(r["id"], r["r_id"]) for r in out} == want


def thinned(rows, gap):
    want = set()
    for key, group in by_key(rows).items():
        last = None
        for r in group:
            if last is None or r[1] - last >= gap:
                last = r[1]
                want.add((key, last))
    return want


@pytest.mark.parametrize("chunk", [40, 500_000])
@pytest.mark.parametrize("gap_s", [1, 300, 20_000])
def test_spaced(frame, rows, gap_s, chunk):
    out = o.spaced(frame, ["key"], "us", gap_s * S, chunk).collect()
    want = thinned(rows, gap_s * S)
    assert len(out) == len(want) and {(r["key"], r["us"]) for r in out} == want


def crowded(n=3000):
    """One key holds nine tenths of the rows in one minute, one is regular, one has no name."""
    rng = random.Random(8)
    rows = [("hot", 50_000 * S + rng.randrange(60 * S), i, 0.0) for i in range(9 * n // 10)]
    rows += [("hot", rng.randrange(100_000) * S, n + i, 0.0) for i in range(n // 20)]
    return rows + [(k, i * 60 * S, 2 * n + i, 0.0) for i in range(n // 40) for k in ("even", None)]


def test_spaced_of_one_crowded_minute(spark):
    rows = crowded()
    df = spark.createDataFrame(rows, "key string, us long, id long, v double")
    for gap_s, chunk in ((1, 100), (7, 64), (300, 100), (3600, 300)):
        out = o.spaced(df, ["key"], "us", gap_s * S, chunk).collect()
        want = thinned(rows, gap_s * S)
        assert len(out) == len(want) and {(r["key"], r["us"]) for r in out} == want


def test_balanced_chunks_are_even_and_ordered(spark):
    df = spark.createDataFrame(crowded(), "key string, us long, id long, v double")
    got = o.balanced(df, ["key"], ["us", "id"], rows=100).groupBy("_chunk").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "us", "id")).alias("lo"), F.max(F.struct("key", "us", "id")).alias("hi")).orderBy("_chunk").collect()
    assert len(got) > 20 and max(r["n"] for r in got) <= 4 * sum(r["n"] for r in got) / len(got)
    place = lambda r: (r["key"] is not None, r["key"] or "", r["us"], r["id"])
    assert all(place(a["hi"]) < place(b["lo"]) for a, b in zip(got, got[1:]))


def test_expire_counts_bytes_of_a_crowded_minute(spark):
    from faultlens.sources.sinks import expire

    rows = crowded()
    df = spark.createDataFrame(rows, "key string, us long, id long, v double").withColumn("ts", F.timestamp_micros("us"))
    out = expire(df, "ts", F.timestamp_seconds(F.lit(100_000)), 24, 700, F.lit(1), tie=["id"]).collect()
    newest = sorted((r for r in rows if r[1] >= 13_600 * S), key=lambda r: (-r[1], r[2]))
    assert {r["id"] for r in out} == {r[2] for r in newest[:700]} and out[0].asDict().keys() == {"key", "us", "id", "v", "ts"}


def test_spaced_boundary(spark):
    df = spark.createDataFrame([("a", t * S) for t in (0, 299, 300, 599, 600)], "key string, us long")
    assert sorted(r["us"] // S for r in o.spaced(df, ["key"], "us", 300 * S).collect()) == [0, 300, 600]


def test_nearest_in_window_keeps_ties(spark):
    rng = random.Random(5)
    # Dense and full of equal times.
    cands = [("hot" if i % 3 == 0 else "cold", rng.randrange(60) * 10 * S, i) for i in range(300)]
    asks = sorted({("hot" if i % 2 else "cold", rng.randrange(600) * S) for i in range(60)})
    out = o.nearest_in_window(
        spark.createDataFrame(asks, "key string, r_us long"), spark.createDataFrame(cands, "key string, c_us long, c_id long"),
        ["key"], 3, 100 * S, 50 * S).collect()
    got = {}
    for r in out:
        got.setdefault((r["key"], r["r_us"]), []).append((abs(r["c_us"] - r["r_us"]), r["c_id"]))
    for key, t in asks:
        inside = [(abs(c - t), i) for k, c, i in cands if k == key and t - 100 * S <= c <= t + 50 * S]
        mine = got.get((key, t), [])
        assert sorted(mine)[:3] == sorted(inside)[:3]
        assert set(mine) <= set(inside) and len(set(mine)) == len(mine) <= 2 * 3 * 3


def test_fuse_tiers_merges_overlaps_and_null_keys(spark):
    schema = "metric string, cluster string, namespace string, service string, anomaly_id long, start_us long, end_us long"
    t1 = spark.createDataFrame([("m", "c", None, "s", 1, 0, 10), ("m", "c", None, "s", 2, 30, 40)], schema)
    t2 = spark.createDataFrame([("m", "c", None, "s", 3, 5, 20), ("m", "c", "n", "s", 4, 5, 20)], schema)
    got = {(r["namespace"], r["start_us"], r["end_us"], r["n_tier1"], r["n_tier2"]) for r in fuse_tiers(t1, t2).collect()}
    assert got == {(None, 0, 20, 1, 1), (None, 30, 40, 1, 0), ("n", 5, 20, 0, 1)}


def test_asof_null_keys_meet_nothing(spark):
    left = spark.createDataFrame([(None, 5), ("a", 5)], "key string, us long")
    right = spark.createDataFrame([(None, 1, 7), ("a", 1, 8)], "key string, r_us long, r_id long")
    assert {(r["key"], r["r_id"]) for r in o.asof_join(left, right, ["key"], "us", "r_us", ["r_id"]).collect()} == {(None, None), ("a", 8)}
