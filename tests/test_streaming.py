import glob
import json
import os
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from faultlens.operators import templates as tm
from faultlens.session import run_dir
from faultlens.sources.manifest import KeyedTable, MergedTable
from faultlens.sources.sinks import publishable, upsert_incidents
from faultlens.streaming import causes, jobs
from faultlens.streaming.counters import CounterListener, Counters
from faultlens.streaming.detector import DetectorState, in_force, settings, stream_detector

S = 1_000_000


def feed(spark, parts):
    """A folder with one file per part, read one file per micro-batch."""
    path = run_dir(spark, "feed")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    return jobs.read_files(spark, path, parts[0].schema, per_trigger=1)


def minute(i):
    """Times after the epoch, where watermarks begin."""
    return (1_000_000 + i * 60) * S


def test_detector_state_survives_batches(spark):
    config = settings(min_samples=30, period=10, trees=50, window_s=6000, limits=[(0.75, "warning")])
    values = np.random.default_rng(4).normal(0, 1, 240)
    values[[100, 200]] = 9
    df = spark.createDataFrame([("s", minute(i), float(v)) for i, v in enumerate(values)], "series string, us long, value double")
    cuts = [df.filter(F.col("us").between(minute(a), minute(b) - 1)) for a, b in ((0, 80), (80, 150), (150, 240))]
    got = spark.read.parquet(jobs.run_to_files(stream_detector(feed(spark, cuts), config), "hits")).orderBy("us").collect()
    counters = Counters()
    jobs.run_to_files(stream_detector(feed(spark, cuts), config), "hits", counters=counters)
    one_pass = DetectorState(config)
    want = [h for h in (one_pass.feed(minute(i), float(v)) for i, v in enumerate(values)) if h]
    assert [(r["us"], r["iso_score"], r["severity"]) for r in got] == [(h["us"], h["iso_score"], "warning") for h in want]
    assert {minute(100), minute(200)} & {h["us"] for h in want}
    counted = counters.total("detector")
    assert counted == {"received": 240, "scored": one_pass.scored, "suppressed": one_pass.suppressed, "emitted": len(want), "active_streams": 3}
    assert counters.latest("detector")["received"] == 90 and one_pass.suppressed > 0


def test_counters_add_up_once(spark):
    counters = Counters()
    listener = CounterListener(counters)
    progress = [SimpleNamespace(id="q", batchId=b, observedMetrics={"alerts": Row(received=n)}) for b, n in ((0, 5), (1, 7), (1, 7))]
    for p in [*progress, SimpleNamespace(id="q", batchId=2, observedMetrics={})]:
        listener.onQueryProgress(SimpleNamespace(progress=p))
    assert counters.total("alerts") == {"received": 12} and counters.latest("alerts") == {"received": 7} and counters.total("x") == {}


def test_records_a_topic_refuses(spark):
    rows = spark.createDataFrame([("k", "v"), ("k", None), (None, "v"), ("k", "é" * 50)], "key string, value string")
    good, bad = publishable(rows, 60)
    assert good.count() == 1 and bad.count() == 3 and bad.select("reason").distinct().collect()[0][0] == "publish error"


def test_late_rows(spark):
    def part(*seconds):
        return spark.createDataFrame([(s,) for s in seconds], "s long").withColumn("ts", F.timestamp_seconds("s"))

    base = run_dir(spark, "late")
    jobs.run_batches(feed(spark, [part(0, 5000), part(4400, 4399, 9000), part(8400, 8399, 100)]), jobs.LateRows(spark, base, "ts"), "late", base)
    sink = jobs.LateRows(spark, base, "ts")
    assert sorted(r["s"] for r in sink.split()[1].collect()) == [100, 4399, 8399]
    # A repeated batch overwrites its own output.
    sink(part(8400, 8399, 100), 2)
    assert sum(x.count() for x in sink.split()) == 8


def test_templates_over_batches_equal_one_batch(spark):
    rows = [("svc", i, f"job {chr(97 + i % 15)} took {i} ms") for i in range(90)]
    df = spark.createDataFrame(rows, "service string, t long, line string").select("service", F.timestamp_seconds("t").alias("ts"), "line")
    base = run_dir(spark, "templates")
    table = jobs.TemplateTable(spark, base)
    jobs.run_batches(feed(spark, [df.filter(F.unix_seconds("ts") % 3 == i) for i in range(3)]), table, "templates", base)
    batch = {(r["template"], r["n"], r["first_seen"]) for r in tm.mine_templates(df).collect()}
    assert {(r["template"], r["n"], r["first_seen"]) for r in table.templates().collect()} == batch
    assert {t for t, _, _ in batch} == {"job <*> took <*> ms"}


def test_unmatched_anomalies_follow_the_window(spark):
    schema = "id long, k string, s long"
    rows = spark.createDataFrame([(1, "a", 10_000), (2, "b", 10_000)], schema), spark.createDataFrame([(9, "z", 90_000)], schema)
    left = feed(spark, rows).select(F.col("id").alias("anomaly_id"), F.col("k").alias("a_key"), F.timestamp_seconds("s").alias("a_ts"))
    cands = spark.createDataFrame([(7, "a", 9_500)], schema), spark.createDataFrame([(8, "y", 90_000)], schema)
    right = feed(spark, cands).select(F.col("id").alias("cand_id"), F.col("k").alias("c_key"), F.timestamp_seconds("s").alias("c_ts"))
    out = spark.read.parquet(jobs.run_to_files(jobs.correlate_streams(left, right, [("a_key", "c_key")]), "pairs")).collect()
    assert {(r["anomaly_id"], r["cand_id"]) for r in out} == {(1, 7), (2, None)}


def test_causes_are_ranked_once_the_window_closed(spark):
    schema = "id long, what string, cluster string, service string, kind string, us long"
    at = 100_000 * S
    first = [(1, "a", "c", "s1", None, at), (2, "a", "c", "s1", None, at + 50 * S), (3, "a", "d", "s1", None, at)]
    found = [(10, "c", "c", "s1", "deploy", at - 60 * S), (11, "c", "c", "s2", "deploy", at - 30 * S), (12, "c", "c", "s9", None, at + 299 * S),
             (13, "c", "c", "s1", "deploy", at - 1801 * S), (14, "c", "e", "s1", "deploy", at)]
    # The second half comes before any window has closed.
    parts = [spark.createDataFrame(rows, schema) for rows in (first + found[:2], found[2:])]
    distances = spark.createDataFrame([("s1", "s1", 0, 0), ("s1", "s2", 1, None)], "service string, cause_service string, down long, up long")
    hist = spark.createDataFrame([("sig", "deploy", 3, 4)], "signature string, kind string, ok long, n long")

    def ranked(rows):
        asks = rows.filter("what = 'a'").select(F.col("id").alias("anomaly_id"), "cluster", "service", F.lit("sig").alias("signature"), F.unix_micros("ts").alias("a_us"))
        cands = rows.filter("what = 'c' or what is null").select(F.col("id").alias("cand_id"), "cluster", "service", "kind", F.unix_micros("ts").alias("c_us"))
        return causes.rank_stream(asks, cands, distances, hist, k=2)

    stream = feed(spark, [p.withColumn("ts", F.timestamp_micros("us")).drop("us") for p in parts])
    got = spark.read.parquet(jobs.run_bounded(ranked, stream, "ts", "causes")).collect()

    def score(gap, topo, hist, kind):
        return round(0.4 * float(np.exp(-gap / 600)) + 0.3 * topo + 0.2 * hist + 0.1 * kind, 6)

    assert {(r["anomaly_id"], r["rank"], r["cand_id"], r["score"]) for r in got} == {
        ("1", 1, "10", score(60, 1, 4 / 6, 1)), ("1", 2, "11", score(30, 0.5, 4 / 6, 1)),
        ("2", 1, "10", score(110, 1, 4 / 6, 1)), ("2", 2, "11", score(80, 0.5, 4 / 6, 1)), ("3", None, None, None)}


def test_settings_of_a_series_are_in_force(spark):
    """Windows, periods and limits of two SLIs; a change takes effect with the first sample that brings it."""
    values = np.random.default_rng(5).normal(0, 1, 300)
    config = settings(min_samples=20, period=10, trees=20, window_s=6000, limits=[(0.75, "warning")])
    own = [None, json.dumps({"window_s": 1800, "period": 5, "limits": [{"min": 0.6, "severity": "info"}, {"min": 0.8, "severity": "critical"}]})]
    rows = [(f"s{k}", minute(i), float(v), own[k] if k < 2 else own[i >= 150]) for i, v in enumerate(values) for k in range(3)]
    df = spark.createDataFrame(rows, "series string, us long, value double, settings string")
    cuts = [df.filter(F.col("us").between(minute(a), minute(b) - 1)) for a, b in ((0, 100), (100, 300))]
    got = {(r["series"], r["us"], r["severity"], r["iso_score"]) for r in spark.read.parquet(jobs.run_to_files(stream_detector(feed(spark, cuts), config), "hits")).collect()}
    want = set()
    for k in range(3):
        state = DetectorState(config)
        for i, v in enumerate(values):
            state.s = in_force(config, own[k] if k < 2 else own[i >= 150])
            hit = state.feed(minute(i), float(v))
            if hit:
                want.add((f"s{k}", hit["us"], hit["severity"], hit["iso_score"]))
    assert got == want and len({w[2] for w in want}) > 1


def test_detector_writes_what_is_new_and_fits_once_an_hour():
    config = settings(min_samples=30, period=10, trees=5, window_s=7200, limits=[(2.0, "never")])
    state, stored, writes, fits = DetectorState(config), {}, 0, []
    for i in range(600):
        state = DetectorState(config, lambda slot: stored[slot], lambda fit=state.model: fit, state.sizes, state.fit_at, state.emit_at, state.since)
        state.feed(i * 60 * S, float(i % 7))
        writes += sum(len(state.slots[n][0]) for n in state.dirty)
        stored.update({n: state.slots[n] for n in state.dirty})
        for n in state.gone:
            stored.pop(n, None)
        fits += [us // (60 * S) for us, _ in state.fits]
    assert fits == list(range(29, 600, 60))
    assert writes <= 3 * 600 and sum(len(t) for t, _ in stored.values()) <= 130


def test_silent_series_are_forgotten(spark):
    config = settings(min_samples=5, window_s=600, trees=5)
    rows = [("a", minute(i), 1.0) for i in range(20)] + [("b", minute(i), 1.0) for i in range(200)]
    df = spark.createDataFrame(rows, "series string, us long, value double")
    cuts = [df.filter(F.col("us").between(minute(a), minute(b) - 1)) for a, b in ((0, 60), (60, 120), (120, 180), (180, 200))]
    base = run_dir(spark, "hits")
    jobs.run_to_files(stream_detector(feed(spark, cuts), config), "hits", base)
    heads = spark.read.format("statestore").option("stateVarName", "head").load(f"{base}/checkpoint")
    assert {r[0] for r in heads.select("key.series").collect()} == {"b"}


def test_bounded_input_is_flushed(spark):
    rows = spark.createDataFrame([(k, 1000 + 40 * k) for k in range(5)], "k long, s long").select("k", F.timestamp_seconds("s").alias("ts"))
    out = spark.read.parquet(jobs.run_bounded(lambda r: jobs.sliding_counts(r, [], "ts", "1 minute"), feed(spark, [rows]), "ts", "windows")).collect()
    assert sum(r["n"] for r in out) == 5


def test_merged_batches_stay_few(spark):
    base = run_dir(spark, "merged")
    table = MergedTable(spark, base, lambda rows: rows.groupBy("k").agg(F.sum("n").alias("n")), fan=3)
    for b in range(17):
        table.add(spark.createDataFrame([(b % 2, 1), (9, 1)], "k long, n long"), b)
    table.add(spark.createDataFrame([(5, 1)], "k long, n long"), 16)  # a batch that comes again
    assert len(table.parts()) <= 2 * 3
    assert {tuple(r) for r in table.rows().groupBy("k").agg(F.sum("n")).collect()} == {(0, 9), (1, 8), (9, 17)}


def test_an_upsert_leaves_other_buckets_alone(spark):
    base = run_dir(spark, "incidents")

    def files():
        names = glob.glob(f"{base}/data/**/*.parquet", recursive=True)
        return {n: os.stat(n).st_mtime_ns for n in names}

    schema = "incident_id long, updated_at long, score double"
    table = upsert_incidents(spark.createDataFrame([(k, 1, 0.0) for k in range(200)], schema), base, buckets=16)
    before = files()
    later = KeyedTable(spark, base, buckets=99)  # the number of buckets is that of the first write
    assert later.upsert(spark.createDataFrame([(7, 2, 1.0), (7, 0, 2.0), (8, 1, 3.0)], schema)) <= 2
    assert later.upsert(spark.createDataFrame([], schema)) == 0
    rows = {r["incident_id"]: (r["updated_at"], r["score"]) for r in table.rows().collect()}
    assert len(rows) == 200 and rows[7] == (2, 1.0) and rows[8] == (1, 3.0) and rows[9] == (1, 0.0)
    assert len(before) == 16 and all(files()[n] == t for n, t in before.items())
    table.upsert(spark.createDataFrame([(7, 3, 1.0, "x")], f"{schema}, note string"))
    assert table.rows().where("note = 'x'").count() == 1 and table.rows().count() == 200
    assert table.vacuum() >= 2 and table.rows().count() == 200
    with pytest.raises(RuntimeError):
        table.manifest.commit(1, {})


def test_ranking_of_a_block_equals_all_pairs():
    """Equal times, equal scores and ids by size; only the nearest of a service and kind are scored."""
    rng = np.random.default_rng(3)
    ranker = causes.Ranker(3, 1800 * S, 300 * S, {"time": 0.4, "topo": 0.3, "hist": 0.2, "kind": 0.1}, 600.0)
    near = [json.dumps({"topo": {"s1": 1.0, "s2": 0.5}, "hist": {"deploy": 0.7}}), json.dumps({"topo": {}, "hist": {}})]
    asks = [(str(i), int(us) * 60 * S, near[i % 2]) for i, us in enumerate(rng.integers(0, 90, 60))]
    pool = [(int(us) * 60 * S, [str(i), f"s{i % 4}", "deploy" if i % 3 else None, "1.0" if i % 3 else "0.0"]) for i, us in enumerate(rng.integers(-40, 100, 900))]
    want = []
    for name, at, text in asks:
        tables, found = json.loads(text), []
        for us, (cand, service, kind, prior) in pool:
            if at - 1800 * S <= us <= at + 300 * S:
                score = 0.4 * np.exp(-abs(us - at) / (600 * S)) + 0.3 * tables["topo"].get(service, 0.0) + 0.2 * tables["hist"].get(kind, 0.5) + 0.1 * float(prior)
                found.append((-score, abs(us - at), int(cand), service, kind, us))
        want += [[name, "c", n, str(c), kind, service, us, round(-float(s), 6)] for n, (s, _, c, service, kind, us) in enumerate(sorted(found, key=lambda f: f[:3])[:3], 1)]
    assert ranker._ranked("c", asks, pool) == want
    assert ranker._ranked("c", asks[:1], []) == [["0", "c", *[None] * 6]]
