import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultlens.operators import detect as dt
from faultlens.operators import series as ts
from faultlens.operators.forest import fit_isolation_forest, grow, isolation_score, joined_trees, score_isolation_forest, tree_samples
from faultlens.sources.records import samples_from_query_results, slis_frame
from faultlens.streaming.detector import DetectorState, settings

S = 1_000_000
MIN = 60 * S


def series(spark, values, name="s", step=MIN):
    return spark.createDataFrame([(name, i * step, float(v)) for i, v in enumerate(values)], "series string, us long, value double")


def test_warm_gate_boundary(spark):
    assert dt.warm_gate(series(spark, range(119)), ["series"]).count() == 0
    (first,) = dt.warm_gate(series(spark, range(120)), ["series"]).collect()
    assert first["us"] == 119 * MIN


def test_history_keeps_the_edge(spark):
    df = spark.createDataFrame([("s", 0, 1.0), ("s", 86_400 * S, 2.0), ("s", 86_400 * S + 1, 3.0)], "series string, us long, value double")
    assert [r["n_history"] for r in dt.history(df, ["series"]).orderBy("us").collect()] == [1, 2, 2]


def test_refit_boundary(spark):
    df = spark.createDataFrame([("s", t * S) for t in (0, 3599, 3600, 7199, 7201)], "series string, us long")
    assert sorted(r["us"] // S for r in dt.refit_schedule(df, ["series"]).collect()) == [0, 3600, 7201]


def test_constant_series(spark):
    fit = dt.fit_window(np.full(130, 5.0))
    assert (fit.mean, fit.spread) == (5.0, 1.0)
    assert np.isfinite(isolation_score(fit.forest, np.array([[0.0]]))).all()
    rows = dt.residual_std(series(spark, [5.0] * 10).withColumn("residual", F.lit(0.0)), ["series"])
    assert rows.first()["residual_std"] == 1.0


def test_spike_has_highest_confidence(spark):
    x = np.arange(400)
    values = 10 + 0.05 * np.sin(2 * np.pi * x / 60) + np.random.default_rng(0).normal(0, 0.1, 400)
    values[350] += 8
    df = series(spark, values)
    warm = dt.warm_gate(df, ["series"])
    scored = dt.judge(dt.score_series(df, ["series"], dt.refit_schedule(warm, ["series"]))).collect()
    assert len(scored) == 281
    spike = next(r for r in scored if r["us"] == 350 * MIN)
    assert spike["confidence"] == max(r["confidence"] for r in scored) and spike["severity"] in ("warning", "critical")
    assert any(r["us"] == 350 * MIN for r in dt.detect(df).collect())


def test_a_model_older_than_two_windows_still_scores(spark):
    df = series(spark, np.random.default_rng(5).normal(0, 1, 900))
    kwargs = {"window_s": 100 * 60, "min_samples": 40}
    warm = dt.warm_gate(df, ["series"], **kwargs)
    fits = dt.refit_schedule(warm.select("series", "us"), ["series"], "us", 700 * 60)
    scored = dt.score_series(df, ["series"], fits, period=20, trees=10, **kwargs)
    assert fits.count() == 2 and scored.count() == warm.count() == 861


def test_blocks_do_not_change_scores(spark):
    """A series that crosses block borders scores like one walked in a single pass."""
    values = np.random.default_rng(1).normal(0, 1, 700)
    kwargs = {"window_s": 200 * 60, "period": 20, "min_samples": 50, "trees": 10}
    df = series(spark, values)
    fits = [r["us"] for r in dt.refit_schedule(dt.warm_gate(df, ["series"], window_s=200 * 60, min_samples=50), ["series"]).collect()]
    got = {r["us"]: r["iso_score"] for r in dt.score_series(df, ["series"], spark.createDataFrame([("s", f) for f in fits], "series string, us long"), **kwargs).collect()}
    fit = None
    want = {}
    for i, v in enumerate(values):
        t = i * MIN
        if i + 1 < 50:
            continue
        if t in fits:
            train = values[max(0, i - 200): i + 1]
            fit = dt.fit_window(train, 20, 10)
        want[t] = float(isolation_score(fit.forest, np.array([[v - fit.mean]]))[0])
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-12 for t in want)


def test_stateful_cooldown_drops_samples_from_history():
    s = DetectorState(settings(min_samples=5, period=2, trees=10, limits=[(0.0, "info")]))
    hits = [s.feed(i * MIN, float(i % 3)) for i in range(12)]
    emitted = [h["us"] // MIN for h in hits if h]
    assert emitted == [4, 9]
    assert sorted(t // MIN for slot in s.sizes for t in s.slot(slot)[0]) == [0, 1, 2, 3, 4, 9]


def test_late_sample_is_pruned_by_time():
    s = DetectorState(settings(window_s=600, min_samples=1000))
    for t in (0, 300, 100, 650, 701):
        s.feed(t * S, float(t))
    assert s.history(701 * S).tolist() == [300, 650, 701]


def test_forest_properties():
    rng = np.random.default_rng(0)
    points = rng.normal(0, 1, (2000, 1))
    model = grow(points)
    scores = isolation_score(model, np.array([[0.0], [2.0], [4.0], [9.0]]))
    assert scores[0] > scores[1] > scores[2] >= scores[3] and (scores < 0).all() and (scores >= -1).all()
    assert (isolation_score(grow(points), points[:5]) == isolation_score(model, points[:5])).all()
    # Another seed tells much the same story.
    a, b = isolation_score(model, points), isolation_score(grow(points, seed=7), points)
    assert np.corrcoef(a, b)[0, 1] > 0.9
    flat = np.c_[rng.normal(0, 1, (500, 2)), np.ones(500)]
    odd = np.array([[6.0, -6.0, 1.0]])
    assert isolation_score(grow(np.r_[flat, odd]), odd)[0] < np.quantile(isolation_score(grow(np.r_[flat, odd]), flat), 0.02)


def test_every_tree_draws_from_all_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 300 != 1, "cold").alias("k"), "id",
                                  (F.hash("id") % 1000 / 100.0).alias("v"))
    picks = tree_samples(df, ["k"], ["id"], trees=5, size=100).collect()
    for k in ("hot", "cold", None):
        all_ids = df.filter(F.col("k").eqNullSafe(k))
        n = all_ids.count()
        for t in range(5):
            marks = sorted((r[1], r[0]) for r in all_ids.select("id", F.xxhash64(F.lit(42), F.lit(t), "id")).collect())
            assert {r["id"] for r in picks if r["k"] == k and r["_tree"] == t} == {i for _, i in marks[:min(100, n)]}
    models = fit_isolation_forest(df, ["k"], F.array("v"), ["id"])
    assert sorted((r["n_trees"], r["psi"]) for r in models.collect()) == [(100, 30), (100, 256), (100, 256)]
    odd = df.unionByName(spark.createDataFrame([("hot", 10_000, 99.0)], "k string, id long, v double"))
    scored = score_isolation_forest(odd, models, ["k"], F.array("v"), block=500).collect()
    assert len(scored) == 9001 and len({r["id"] for r in scored}) == 9001
    hot = {r["id"]: r["iso_score"] for r in scored if r["k"] == "hot"}
    assert hot[10_000] < np.quantile(list(hot.values()), 0.05)


def test_joined_trees_score_like_their_mean():
    points = np.random.default_rng(1).normal(0, 1, (300, 2))
    trees = [grow(points, 1, seed=s) for s in range(7)]
    one = isolation_score(joined_trees(trees), points)
    each = np.array([np.log2(-isolation_score(t, points)) for t in trees])
    assert np.allclose(np.log2(-one), each.mean(axis=0))


@pytest.mark.parametrize(("value", "kept"), [([1700000000.5, "3.5"], True), ([1, "NaN"], False), ([1], False), ([1, "abc"], False), (None, False)])
def test_clean_samples(spark, value, kept):
    text = json.dumps({"status": "success", "data": {"result": [{} if value is None else {"value": value}]}})
    answers = spark.createDataFrame([("a", text)], "sli_id string, value string")
    rows = ts.clean_samples(samples_from_query_results(answers, slis_frame(spark, [{"id": "a", "promql": "q", "metric": "m"}]))).collect()
    assert len(rows) == kept
    if kept:
        assert rows[0]["labels"] == {} and rows[0]["ts"].microsecond == 500_000 and rows[0]["value"] == 3.5


def test_counter_reset(spark):
    df = spark.createDataFrame([("s", t * S, v) for t, v in ((0, 10.0), (60, 70.0), (120, 5.0), (600, 8.0))], "series string, us long, value double")
    rows = ts.counter_rate(df, ["series"], "us", "value", 300).orderBy("us").collect()
    assert [round(r["rate"] * 300, 6) for r in rows] == [0.0, 60.0, 65.0, 0.0]


def test_no_cluster_label_gives_default(spark):
    df = spark.createDataFrame([("a", "m", "q", {"service": "", "deployment": "d"}, 1.0)], "sli_id string, metric string, promql string, labels map<string,string>, value double")
    df = df.select("*", F.lit("2024-01-01").cast("timestamp").alias("ts"), *[F.lit(0.5).alias(c) for c in ("iso_score", "baseline_mean", "baseline_std", "residual", "confidence")], F.lit("info").alias("severity"))
    (s,) = dt.samples_to_signals(df, "home").collect()
    assert (s["cluster"], s["service"], s["detector"], s["annotations"]) == ("home", "d", "ml:isoforest:a", {})


def test_settings_of_each_series(spark):
    """A series with settings of its own is judged like one alone with these as defaults."""
    x = np.arange(400)
    values = 10 + np.sin(2 * np.pi * x / 30) + np.random.default_rng(3).normal(0, 0.2, 400)
    values[[300, 333]] += 8
    both = series(spark, values).unionByName(series(spark, values, "t")).unionByName(series(spark, values, "u"))
    limits = [(0.4, "info"), (0.75, "critical")]
    own = spark.createDataFrame([("t", 9000, 30, limits), ("u", None, None, None)],
                                "series string, baseline_window_s int, seasonality_period int, severity_thresholds array<struct<min:double,severity:string>>")
    got = {(r["series"], r["us"], r["severity"], r["iso_score"]) for r in dt.detect(both, settings=own, trees=30).collect()}
    plain = {(r["us"], r["severity"], r["iso_score"]) for r in dt.detect(series(spark, values), trees=30).collect()}
    assert {g[1:] for g in got if g[0] == "s"} == plain == {g[1:] for g in got if g[0] == "u"}
    df = series(spark, values)
    warm = dt.warm_gate(df, ["series"], window_s=9000)
    scored = dt.score_series(df, ["series"], dt.refit_schedule(warm, ["series"]), window_s=9000, period=30, trees=30)
    judged = dt.judge(scored, dt.thresholds(limits)).filter("severity is not null")
    alone = {(r["us"], r["severity"], r["iso_score"]) for r in dt.cooldown(judged, ["series"]).collect()}
    assert {g[1:] for g in got if g[0] == "t"} == alone != plain and len(alone) > 1


def test_pointwise_residuals_follow_the_phase(spark):
    values = np.tile(np.arange(12.0), 30)
    fit = dt.fit_window(values[:120], 12, 5)
    assert fit.baseline(0, "pointwise") == fit.last[-1] and fit.baseline(5, "pointwise") == fit.last[4] and fit.baseline(3) == fit.mean
    config = settings(min_samples=48, period=12, trees=5, limits=[(2.0, "x")], residual_mode="pointwise")
    df = series(spark, values)
    warm = dt.warm_gate(df, ["series"], min_samples=48)
    rows = dt.score_series(df, ["series"], dt.refit_schedule(warm, ["series"]), period=12, min_samples=48, trees=5, residual_mode="pointwise").orderBy("us").collect()
    state, want = DetectorState(config), []
    for i, v in enumerate(values):
        state.feed(i * MIN, float(v))
        if state.model:
            want.append(v - float(state.model.baseline(state.since, "pointwise")))
    assert np.allclose([r["residual"] for r in rows], want) and np.median(np.abs(want)) < 0.5


@pytest.mark.parametrize("mode", dt.RESIDUAL_MODES)
@pytest.mark.parametrize("limit", [2.0, 0.62, 0.0])
def test_many_samples_at_once_equal_one_after_another(monkeypatch, mode, limit):
    """Same hits, fits, counts and history; most samples are scored together."""
    from faultlens.streaming import detector

    config = settings(window_s=7200, min_samples=60, period=10, trees=20, limits=[(limit, "info"), (0.75, "warning")], residual_mode=mode)
    rng = np.random.default_rng(11)
    us = np.sort(rng.integers(0, 30_000, 4000)) * S  # equal times too
    us[2500:] += 9000 * S  # a gap longer than the window
    values = rng.normal(0, 1, len(us))
    cuts = [0, 3, 1200, 1201, 2800, 4000]
    us[1200:1210] -= 120 * S  # a batch that begins before the last one's end
    us[1201:] = np.sort(us[1201:])
    one, want = DetectorState(config), []
    for u, v in zip(us.tolist(), values.tolist()):
        hit = one.feed(u, v)
        want += [hit] if hit else []
    calls, score = [], detector.isolation_score
    monkeypatch.setattr(detector, "isolation_score", lambda *a: calls.append(len(a[1])) or score(*a))
    many, got = DetectorState(config), []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        got += [h for _, h in many.feed_all(us[lo:hi], values[lo:hi])]
    assert got == want and many.fits == one.fits and (many.scored, many.suppressed, many.since) == (one.scored, one.suppressed, one.since)
    assert many.sizes == one.sizes and many.history(int(us[-1])).tolist() == one.history(int(us[-1])).tolist()
    assert limit < 2.0 or len(calls) < one.scored / 10


def test_rows_of_a_series_take_few_bytes():
    """Texts of a series are held once, whatever the number of its rows."""
    import json
    import tracemalloc

    from faultlens.streaming.detector import in_order

    def chunks(n):
        for lo in range(0, n, 1000):
            at = np.arange(lo, lo + 1000)
            yield pd.DataFrame({"us": at[::-1] * 7 % n, "value": at * 0.5, "settings": [json.dumps({"window_s": 600 + 0 * k}) if lo else None for k in at.tolist()],
                                "subject": [json.dumps({"sli_id": "sli_view", "labels": {"service": "shop"}, "n": int(k >= n // 2)}) for k in at.tolist()]})

    tracemalloc.start()
    us, values, own, subjects, texts = in_order(chunks(100_000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (np.diff(us) >= 0).all() and len(us) == len(values) == 100_000 and peak < 100 * 100_000
    assert {texts[k] for k in own.tolist()} == {None, '{"window_s": 600}'} and len(set(subjects.tolist())) == 2


def test_picked_points_are_those_of_one_draw():
    from faultlens.operators.forest import _picks

    for n, psi in ((100, 100), (300, 256), (50_000, 256)):
        noise = np.random.default_rng(3).random((4, n))
        rng = np.random.default_rng(3)
        for k in range(4):
            assert set(_picks(rng, n, psi)) == set(np.argsort(noise[k])[:psi])
