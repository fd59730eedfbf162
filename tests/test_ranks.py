"""Window order statistics against plain Python."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultlens.operators.ranks import WindowRanks
from faultlens.operators.series import _moments, quantile_over_time, rolling_mad, rolling_zscore

S = 1_000_000


@pytest.mark.parametrize("n", [1, 2, 3, 64, 65, 500])
def test_selection(n):
    rng = np.random.default_rng(n)
    v = rng.integers(0, 40, n).astype(float) if n % 2 else rng.normal(0, 1, n)
    r = WindowRanks(v)
    lo = rng.integers(0, n, 400)
    hi = np.array([rng.integers(a + 1, n + 1) for a in lo])
    k = np.array([rng.integers(0, b - a) for a, b in zip(lo, hi)])
    c = rng.normal(0, 30, 400)
    c[:200] = v[rng.integers(0, n, 200)]
    assert r.kth(lo, hi, k).tolist() == [sorted(v[a:b])[i] for a, b, i in zip(lo, hi, k)]
    assert r.deviation(lo, hi, c, k).tolist() == [sorted(abs(v[a:b] - m))[i] for a, b, i, m in zip(lo, hi, k, c)]


def test_windows_of_series(spark):
    rng = random.Random(2)
    rows = [(None if i % 3 else "a", rng.randrange(40_000) * S, i, rng.choice([None, math.nan, *[float(rng.randrange(9)) for _ in range(9)]])) for i in range(700)]
    rows += [("b", 5 * S, 1000, None), ("b", 5 * S, 1001, None), ("c", -7_300 * S, 1002, 2.5)]
    df = spark.createDataFrame(rows, "series string, us long, id long, value double")
    near = {}
    for s, t, i, _ in rows:
        near[i] = [v for s2, t2, _, v in rows if s2 == s and t - 1800 * S <= t2 <= t and v is not None and not math.isnan(v)]
    got = quantile_over_time(df, ["series"], "us", "value", 0.9, 1800)
    assert got.columns == ["series", "us", "id", "value", "quantile"]
    for r in got.collect():
        want = float(np.quantile(near[r["id"]], 0.9)) if near[r["id"]] else None
        assert r["quantile"] == want or abs(r["quantile"] - want) < 1e-12
    out = rolling_mad(df, ["series"], "us", "value", 1800).collect()
    assert len(out) == len(rows)
    for r in out:
        v = near[r["id"]]
        if not v:
            assert r["median"] is None and r["mad"] is None and r["is_outlier"] is None
            continue
        m = statistics.median(v)
        d = statistics.median([abs(x - m) for x in v])
        assert (r["median"], r["mad"]) == (m, d)
        if r["value"] is not None and not math.isnan(r["value"]):
            assert r["is_outlier"] == (abs(r["value"] - m) > 3 * 1.4826 * d)


def test_zscores_keep_small_spreads_and_null_rows(spark):
    """A window after a far larger value, one without spread, rows without a value, a value that is no number."""
    rng = random.Random(4)
    values = [1e12] + [rng.random() for _ in range(300)] + [7.0] * 50 + [None, None] + [rng.random() for _ in range(40)] + [float("nan")] + [1.0, 2.0]
    rows = [(i, i * 10_000_000, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, us long, v double").withColumn("k", F.lit("a"))
    got = {r["id"]: r["zscore"] for r in rolling_zscore(df, ["k"], "us", "v", 300).collect()}
    assert len(got) == len(rows)
    for i, us, v in rows:
        window = [x for _, u, x in rows if us - 300_000_000 <= u <= us and x is not None]
        if v is None or len(window) < 2 or max(window) == min(window):
            assert got[i] is None
        elif any(math.isnan(x) for x in window):
            assert math.isnan(got[i])
        else:
            assert got[i] == pytest.approx((v - statistics.fmean(window)) / statistics.stdev(window), rel=1e-9, abs=1e-9)


def test_moments_take_logarithmic_work():
    n = 200_000
    values = np.random.default_rng(1).normal(0, 1, n)
    lo, hi = np.maximum(np.arange(n) - 100_000, 0), np.arange(n) + 1
    count, mean, squares = _moments(values, lo, hi)
    assert (count == hi - lo).all()
    assert mean[-1] == pytest.approx(values[lo[-1]:].mean()) and squares[-1] == pytest.approx(values[lo[-1]:].var() * count[-1])
