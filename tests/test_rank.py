import math
import random

from faultlens.operators import correlate as cr

S = 1_000_000
KINDS = ["deploy", "config_change", "rollback"]


def data(seed=3, n_anomalies=40, n_candidates=500, span_s=4000):
    """Dense windows, one cluster with most rows, many equal times."""
    rng = random.Random(seed)
    anomalies = [(i, "hot" if i % 3 else "c1", f"s{rng.randrange(5)}", f"g{i % 2}", rng.randrange(span_s // 10) * 10 * S)
                 for i in range(n_anomalies)]
    candidates = [(1000 + i, "hot" if i % 3 else "c1", f"s{rng.randrange(5)}", rng.choice(KINDS), rng.randrange(span_s // 10) * 10 * S)
                  for i in range(n_candidates)]
    # A NULL service, signature or kind is ranked like any other row.
    anomalies += [(900, "hot", None, "g0", 500 * S), (901, "hot", "s1", None, 900 * S), (902, "hot", None, None, 900 * S)]
    candidates += [(5000 + i, "hot", None if i % 2 else "s1", None if i % 3 else "deploy", 100 * i * S) for i in range(30)]
    near = [(f"s{a}", f"s{b}", (b - a) % 5 if (b - a) % 5 <= 1 else None, (a - b) % 5 if (a - b) % 5 <= 1 else None)
            for a in range(5) for b in range(5)]
    near = [d for d in near if d[2] is not None or d[3] is not None]
    hist = [("g0", "deploy", 3, 4), ("g1", "config_change", 0, 5)]
    return anomalies, candidates, near, hist


def brute(anomalies, candidates, near, hist):
    dist = {(a, b): (d, u) for a, b, d, u in near}
    past = {(g, k): (ok, n) for g, k, ok, n in hist}
    out = {}
    for aid, cluster, service, sig, t in anomalies:
        scored = []
        for cid, c2, s2, kind, ct in candidates:
            if c2 != cluster or not t - cr.BEFORE_US <= ct <= t + cr.AFTER_US:
                continue
            down, up = dist.get((service, s2), (None, None))
            topo = max([1 / (1 + down)] if down is not None else [0.0], [0.5 / (1 + up)] if up is not None else [0.0])[0]
            ok, n = past.get((sig, kind), (0, 0))
            score = (0.4 * math.exp(-abs(ct - t) / (600.0 * S)) + 0.3 * topo + 0.2 * (ok + 1) / (n + 2) + 0.1 * cr.KIND_PRIOR.get(kind, 0.0))
            scored.append((-score, abs(ct - t), cid))
        out[aid] = [(cid, round(-s, 6)) for s, _, cid in sorted(scored)[:5]]
    return {k: v for k, v in out.items() if v}


def ranked(spark):
    anomalies, candidates, near, hist = data()
    rows = cr.rank_causes(
        spark.createDataFrame(anomalies, "anomaly_id long, cluster string, service string, signature string, a_us long"),
        spark.createDataFrame(candidates, "cand_id long, cluster string, service string, kind string, c_us long"),
        spark.createDataFrame(near, "service string, cause_service string, down int, up int"),
        spark.createDataFrame(hist, "signature string, kind string, ok long, n long")).collect()
    out = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        out.setdefault(r["anomaly_id"], []).append((r["cand_id"], r["score"]))
    return out


def test_ranking_matches_brute_force(spark):
    want = brute(*data())
    assert len(want) == 43 and ranked(spark) == want


def test_only_pairs_that_can_place_are_formed(spark):
    """Of dense windows at distinct times no more than k pairs a subject leave the search, over many chunks."""
    rng = random.Random(5)
    at = rng.sample(range(4_000_000), 2500)
    asks = spark.createDataFrame([("c", f"s{i % 5}", f"g{i % 3}", t * 1000) for i, t in enumerate(at[:500])], "cluster string, service string, signature string, a_us long")
    cands = spark.createDataFrame([(i, "c", f"s{i % 7}", KINDS[i % 3], t * 1000) for i, t in enumerate(at[500:])], "cand_id long, cluster string, service string, kind string, c_us long")
    near = spark.createDataFrame([(f"s{a}", f"s{b}", 1, None) for a in range(5) for b in range(4)], "service string, cause_service string, down int, up int")
    hist = spark.createDataFrame([("g0", "deploy", 3, 4)], "signature string, kind string, ok long, n long")
    pairs = cr.nearest_pairs(asks, cands, near, hist, 5, cr.BEFORE_US, cr.AFTER_US)
    n = pairs.groupBy("service", "signature", "a_us").count().collect()
    assert len(n) == 500 and max(r["count"] for r in n) == 5
