"""Templates around incidents' onsets, counted without a shuffle of pairs."""

import random

from pyspark.sql import functions as F

from faultlens.functions.columns import SECOND as S
from faultlens.operators import templates as tm
from faultlens.operators.templates import onset_shifts

MIN = 60 * S


def test_onset_shifts_equal_a_count_per_incident(spark):
    rng = random.Random(7)
    lines = [(rng.choice(["a", "b", None]), rng.randrange(600) * MIN + rng.randrange(MIN), rng.choice(["disk full", "node up", "node up", "job done", f"rare w{'xyz'[i % 3]}"])) for i in range(500)]
    # Two incidents share a slot, one comes twice, one has two onsets in a service, some have no id or no service.
    onsets = [(i, rng.choice(["a", "b"]), rng.randrange(600) * MIN) for i in range(40)]
    onsets += [(50, "a", 300 * MIN), (51, "a", 300 * MIN + 5), (51, "a", 300 * MIN + 5), (52, "b", 200 * MIN), (52, "b", 260 * MIN), (None, "a", 100 * MIN), (None, "a", 150 * MIN), (53, None, 9)]
    logs = spark.createDataFrame(lines, "service string, us long, line string").withColumn("ts", F.timestamp_micros("us"))
    fields = spark.createDataFrame([("a", "node up", 5)], "service string, template string, seen long")
    out = onset_shifts(logs, spark.createDataFrame(onsets, "incident long, service string, onset_us long"), 3600, 1800, carried=fields)
    got = sorted((repr(r["incident"]), r["service"], r["template"], r["count_before"], r["count_after"], r["seen"]) for r in out.collect())
    latest = {}
    for incident, service, us in sorted(onsets, key=lambda o: o[2]):
        edge = us // MIN * MIN
        for template in {t for s, _, t in lines if s == service and s is not None}:
            slots = [u // MIN * MIN for s, u, t in lines if (s, t) == (service, template)]
            b, a = sum(edge - 60 * MIN <= u < edge for u in slots), sum(edge <= u < edge + 30 * MIN for u in slots)
            if a + b:
                latest[incident, service, template] = (b, a)
    want = [(repr(i), s, t, b, a, 5 if (s, t) == ("a", "node up") else None) for (i, s, t), (b, a) in latest.items() if b == 0 or not 0.5 < (a + 1) / (b + 1) < 2]
    assert got == sorted(want)


def test_pairs_of_onsets_and_templates_are_not_shuffled(spark):
    """Twelve hundred incidents of one slot with a hundred templates: what is written grows with neither's product."""
    logs = spark.range(100).select(F.lit("a").alias("service"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.concat(F.lit("w"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("line"))
    incidents = spark.range(1200).select(F.col("id").alias("incident"), F.lit("a").alias("service"), F.lit(50 * MIN).alias("onset_us"))
    rows = onset_shifts(logs, incidents, 7200, 7200, max_words=200)
    assert rows.count() == 1200 * 100
    joined = rows._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    top = joined[:joined.index("Join")]
    assert "Exchange" not in top and "HashAggregate" not in top


def test_shifts_put_onto_rows_equal_the_rows_and_are_not_shuffled(spark):
    """Each row gets its incident's shifts, sharpest first; several onsets of an incident, a missing one and repeated rows included."""
    rng = random.Random(3)
    lines = [(rng.choice("ab"), rng.randrange(900) * MIN + rng.randrange(MIN), rng.choice(["disk full", "node up", "node up", "job done", f"rare w{'xyz'[i % 3]}"])) for i in range(500)]
    logs = spark.createDataFrame(lines, "service string, us long, line string").withColumn("ts", F.timestamp_micros("us"))
    one = [(i, rng.choice("ab"), rng.randrange(900) * MIN) for i in range(40)] + [(41, "a", 5000 * MIN), (None, "a", 9)]
    fields = spark.createDataFrame([("a", "node up", {1: "x"}), ("b", "node up", {})], "service string, template string, seen map<int,string>")
    onto = spark.createDataFrame([(i, f"r{i}", "own") for i in [*range(45), 3, 51, None]], "incident long, name string, service string")
    for onsets in (one, [*one, (51, "a", 300 * MIN), (51, "b", 300 * MIN), (51, "b", 420 * MIN), (3, "a", 100 * MIN), (3, "b", 200 * MIN)]):
        incidents = spark.createDataFrame(onsets, "incident long, service string, onset_us long")
        plain = onset_shifts(logs, incidents, 3600, 1800, carried=fields).withColumn("sharp", F.round(F.abs(F.log("ratio")), 9))
        want = {}
        for r in sorted(plain.collect(), key=lambda r: (-r["sharp"], r["service"], r["template"])):
            want.setdefault(r["incident"], []).append((r["service"], r["template"], r["count_before"], r["count_after"], r["seen"]))
        rows = onset_shifts(logs, incidents, 3600, 1800, carried=fields, onto=onto)
        assert rows.columns == ["incident", "name", "service", "shifts"]
        got = sorted((repr(r["incident"]), r["name"], r["service"], [tuple(x) for x in r["shifts"] or []]) for r in rows.collect())
        assert got == sorted((repr(i), f"r{i}", "own", want.get(i, []) if i is not None else []) for i in [*range(45), 3, 51, None])
    alone = onset_shifts(logs, spark.createDataFrame(one, "incident long, service string, onset_us long"), 3600, 1800, onto=onto)
    plan = alone._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Exchange" not in plan[:plan.index("Join")] and plan.count("collect_list") == 2


def test_lines_stay_where_they_are_for_small_buckets(spark):
    """Few crowded buckets are taken to the lines, whatever the broadcast threshold; large ones are shuffled to."""
    lines = [(s, f"{w} {x} end") for s in ("a", None) for w in ("open", "shut") for x in ("alpha beta gamma delta".split() if w == "shut" else "bcdefghijkl")]
    logs = spark.createDataFrame(lines, "service string, line string").withColumn("ts", F.timestamp_seconds(F.lit(5)))
    threshold, small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), tm.SMALL_BYTES
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {}
        for tm.SMALL_BYTES in (small, 0):
            rows = tm.templated(logs)
            assert ("BroadcastHashJoin" in rows._jdf.queryExecution().toString()) == (tm.SMALL_BYTES > 0)
            assert "example" not in rows.columns
            found[tm.SMALL_BYTES] = sorted((str(r["service"]), r["template"], r["n"]) for r in tm.fold_templates(rows).collect())
    finally:
        tm.SMALL_BYTES = small
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found[0] == found[small]
    assert found[0] == sorted((s, t, n) for s in ("a", "None") for t, n in [("open <*> end", 11), *[(f"shut {x} end", 1) for x in "alpha beta gamma delta".split()]])
