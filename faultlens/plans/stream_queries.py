"""Streaming jobs run over the test tables as file streams."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from faultlens.functions.columns import SECOND, micros, ntz
from faultlens.plans import twins
from faultlens.plans.alert_queries import ALERTS, as_of, payload_texts
from faultlens.plans.log_queries import TEMPLATES
from faultlens.plans.registry import query
from faultlens.plans.series_queries import slis, spaced_sql
from faultlens.plans.twins import EVENTS, INCIDENT_PARTS
from faultlens.operators import alerts as al
from faultlens.operators import templates as tm
from faultlens.operators.correlate import history
from faultlens.schemas import THRESHOLDS
from faultlens.session import materialise, run_dir
from faultlens.sources.records import read_alert_payloads
from faultlens.streaming import causes, detector, jobs


def stream_of(spark, sf_dir, name):
    """The table as a file stream, be it one file or a folder of parts; the braces let a stream's path name a single file."""
    schema = twins.table(spark, sf_dir, name).schema
    return jobs.read_files(spark, f"{sf_dir}/{{{name}}}.parquet", schema)


def event_stream(spark, sf_dir):
    e = stream_of(spark, sf_dir, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), micros(F.col("ts")).alias("us"), "user_id", "event_type", "value")


def stored(spark, stream, label):
    return spark.read.parquet(jobs.run_to_files(stream, label))


@query("st1_stream_alerts", f"""WITH {ALERTS}
SELECT fingerprint AS "key", count(*) AS n, CAST(floor(sum(duration_s)) AS BIGINT) AS duration FROM sig GROUP BY 1""")
def st1(spark, sf_dir):
    texts = materialise(payload_texts(spark, sf_dir), "payloads")
    stream = spark.readStream.schema(texts.schema).parquet(texts.inputFiles()[0].rsplit("/", 1)[0])
    rows = stored(spark, jobs.stream_alerts(stream, as_of()), "signals")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(
        F.get_json_object("value", "$.values.duration_s").cast("double")).cast("long").alias("duration"))


@contextmanager
def rocksdb(spark):
    """The state store that keyed state with timers needs, while a query runs."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@query("st2_stream_detector")
def st2(spark, sf_dir):
    """Tier 2 from samples to signals: events as samples of their SLI, errors with settings of their own."""
    ev = event_stream(spark, sf_dir)
    samples = ev.select(F.concat(F.lit("sli_"), F.col("event_type")).alias("sli_id"), "ts", "value",
                        F.create_map(F.lit("service"), F.lit("shop")).alias("labels"))
    with rocksdb(spark):
        signals = detector.stream_tier2(samples, slis(spark), "home", detector.settings(min_samples=60, trees=50), as_of())
        return stored(spark, signals, "signals").select(
            "detector", "tier", "fingerprint", "service", "severity", "confidence", ntz(F.col("ts_started")).alias("ts_started"),
            *[F.col(f"values.{c}").alias(c) for c in ("observed", "baseline_mean", "baseline_std", "iso_score", "residual")])


OWN_WINDOWS = f"""WITH RECURSIVE {EVENTS},
cnt AS (SELECT 'sli_' || event_type AS series, us, count(*) OVER (PARTITION BY event_type ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS n
        FROM ev WHERE event_type <> 'error'
        UNION ALL SELECT 'sli_error', us, count(*) OVER (ORDER BY us RANGE BETWEEN 43200000000 PRECEDING AND CURRENT ROW) FROM ev WHERE event_type = 'error'),
warm AS (SELECT series, us, n FROM cnt WHERE n >= 30),
{spaced_sql('warm', 3_600_000_000)}"""


@query("st2_detector_fits", f"{OWN_WINDOWS} SELECT kept.series, kept.us, warm.n AS n_train FROM kept JOIN warm ON kept.series = warm.series AND kept.us = warm.us")
def st2b(spark, sf_dir):
    """When the stateful detector fits anew and from how many samples, each SLI by its own window, over three deliveries.

    No limit is within reach here, so that nothing is emitted and no sample suppressed.
    """
    ev = twins.events(spark, sf_dir).select(F.concat(F.lit("sli_"), F.col("event_type")).alias("sli_id"), "us", "value")
    source, base = run_dir(spark, "arrivals"), run_dir(spark, "fits")
    own = slis(spark).select(F.col("id").alias("sli_id"), detector.own_settings(F.col("baseline_window_s"), F.col("seasonality_period"), F.lit(None).cast(THRESHOLDS)).alias("settings"))
    config = detector.settings(min_samples=30, trees=5, limits=[(2.0, "critical")])
    edges = ev.agg(F.min("us").alias("a"), F.max("us").alias("z")).first()
    with rocksdb(spark):
        for part in range(3):  # the next third of the time arrives once the last is done
            third = F.least(F.lit(2), F.floor((F.col("us") - edges.a) * 3 / F.lit(max(1, edges.z - edges.a))))
            ev.filter(third == part).write.mode("append").parquet(source)
            stream = jobs.read_files(spark, source, ev.schema).join(own, "sli_id").withColumnRenamed("sli_id", "series")
            out = jobs.run_to_files(detector.stream_fits(stream, config), "fits", base)
    return spark.read.parquet(out)


@query("st3_sliding_windows", f"""WITH {EVENTS},
w AS (SELECT event_type, us // 3600000000 * 3600000000 - i * 3600000000 AS s FROM ev CROSS JOIN (SELECT unnest([0, 1]) AS i))
SELECT make_timestamp(s) AS window_start, make_timestamp(s + 7200000000) AS window_end, event_type, count(*) AS n FROM w GROUP BY 1, 2, 3""")
def st3(spark, sf_dir):
    out = jobs.run_bounded(lambda ev: jobs.sliding_counts(ev, ["event_type"], "ts", "2 hours", "1 hour"), event_stream(spark, sf_dir), "ts", "windows")
    return spark.read.parquet(out).select(ntz(F.col("window_start")).alias("window_start"), ntz(F.col("window_end")).alias("window_end"), "event_type", "n")


@query("st3_tumbling_edges", """WITH r AS (SELECT epoch_us(l_shipdate) AS us, 'p' || (l_partkey % 5) AS src, 's' || (l_suppkey % 5) AS dst FROM lineitem)
SELECT make_timestamp(us) AS window_start, src, dst, round(count(*) / 30.0::DOUBLE, 9) AS weight FROM r GROUP BY 1, 2, 3""")
def st3b(spark, sf_dir):
    item = stream_of(spark, sf_dir, "lineitem")
    rows = item.select(F.col("l_shipdate").cast("timestamp").alias("ts"), F.concat(F.lit("p"), (F.col("l_partkey") % 5).cast("string")).alias("src"),
                       F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string")).alias("dst"))
    out = spark.read.parquet(jobs.run_bounded(jobs.windowed_edges, rows, "ts", "edges"))
    return out.select(ntz(F.col("window_start")).alias("window_start"), "src", "dst", F.round("weight", 9).alias("weight"))


@query("st4_stream_dedup", f"""WITH {ALERTS}
SELECT fingerprint, ts_started, ts_resolved IS NOT NULL AS closed FROM sig GROUP BY 1, 2, 3""")
def st4(spark, sf_dir):
    texts = materialise(payload_texts(spark, sf_dir), "payloads")
    stream = spark.readStream.schema(texts.schema).parquet(texts.inputFiles()[0].rsplit("/", 1)[0])
    good, _ = read_alert_payloads(stream)
    signals = al.alerts_to_signals(al.explode_alerts(good), as_of()).select("fingerprint", "ts_started", "ts_resolved", "ts_detected")
    rows = stored(spark, jobs.dedupe_stream(signals), "deduped")
    return rows.select("fingerprint", ntz(F.col("ts_started")).alias("ts_started"), F.col("ts_resolved").isNotNull().alias("closed"))


@query("st5_stream_correlation", f"""WITH {INCIDENT_PARTS}
SELECT CAST(a.anomaly_id AS VARCHAR) AS anomaly_id, a.cluster, "rank", CAST(cand_id AS VARCHAR) AS cand_id, kind, cause_service, c_us, score
FROM anom a LEFT JOIN ranked r ON a.anomaly_id = r.anomaly_id""")
def st5(spark, sf_dir):
    """Each error's five best causes in its cluster, from 30 minutes before to 5 after; errors without any are kept."""
    ev = twins.events(spark, sf_dir)
    distances, hist = materialise(twins.distances(ev), "distances"), materialise(history(twins.feedback(ev)), "history")

    def ranked(rows):
        rows = rows.withColumns({"service": F.concat(F.lit("svc"), (F.col("user_id") % 10).cast("string")), "cluster": F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")),
                                 "k": F.get_json_object("props", "$.k").cast("long"), "us": micros(F.col("at"))})
        # The end mark has no type, so it is neither an anomaly nor a candidate: it goes with the candidates, without a cluster.
        found = rows.filter("event_type IS NULL OR event_type IN ('signup', 'purchase')").select(
            F.col("event_id").alias("cand_id"), "cluster", "service", F.when(F.col("event_type") == "signup", "deploy").otherwise("config_change").alias("kind"), F.col("us").alias("c_us"))
        return causes.rank_stream(twins.anomalies(rows), found, distances, hist)

    stream = stream_of(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("at"), "user_id", "event_type", "props")
    with rocksdb(spark):
        return spark.read.parquet(jobs.run_bounded(ranked, stream, "at", "causes"))


@query("st5_stream_pairs", f"""WITH {EVENTS}
SELECT a.event_id AS anomaly_id, c.event_id AS cand_id FROM (SELECT * FROM ev WHERE event_type = 'error') a
LEFT JOIN (SELECT * FROM ev WHERE event_type IN ('signup', 'purchase')) c
 ON a.user_id = c.user_id AND c.us BETWEEN a.us - 21600000000 AND a.us + 300000000""")
def st5b(spark, sf_dir):
    """Errors with the candidates of the same user in their window, as a stream-stream join; errors without any are kept."""
    def joined(ev):
        # The end mark is on both sides, for a user of each side's own.
        anomalies = ev.filter("event_type = 'error' OR event_type IS NULL").select(F.col("event_id").alias("anomaly_id"), F.coalesce("user_id", F.lit(-1)).alias("a_user"), F.col("ts").alias("a_ts"))
        found = ev.filter("event_type IN ('signup', 'purchase') OR event_type IS NULL").select(F.col("event_id").alias("cand_id"), F.coalesce("user_id", F.lit(-2)).alias("c_user"), F.col("ts").alias("c_ts"))
        return jobs.correlate_streams(anomalies, found, [("a_user", "c_user")], 6 * 3600 * SECOND)

    return spark.read.parquet(jobs.run_bounded(joined, event_stream(spark, sf_dir), "ts", "pairs")).select("anomaly_id", "cand_id")


@query("st6_episode_sessions", f"""WITH {EVENTS},
g AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) <= 3600000000 THEN 0 ELSE 1 END AS b FROM ev),
i AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY us) AS isl FROM g)
SELECT user_id, make_timestamp(min(us)) AS started, make_timestamp(max(us) + 3600000000) AS ended, count(*) AS n_emissions FROM i GROUP BY user_id, isl""")
def st6(spark, sf_dir):
    rows = spark.read.parquet(jobs.run_bounded(lambda ev: jobs.episode_sessions(ev, ["user_id"]), event_stream(spark, sf_dir), "ts", "episodes"))
    return rows.select("user_id", ntz(F.col("started")).alias("started"), ntz(F.col("ended")).alias("ended"), "n_emissions")


@query("st7_late_rows", f"""WITH {EVENTS}
SELECT CASE WHEN k >= 50 AND us < (SELECT max(us) FROM ev WHERE k < 50) - 600000000 THEN 'late' ELSE 'kept' END AS outcome, count(*) AS n FROM ev GROUP BY 1""")
def st7(spark, sf_dir):
    ev = twins.events(spark, sf_dir).select("event_id", "ts", "k")
    source, base = run_dir(spark, "arrivals"), run_dir(spark, "late")
    sink = jobs.LateRows(spark, base, "ts")
    for part in ("k < 50", "k >= 50"):  # the second half arrives once the first is done
        ev.filter(part).write.mode("append").parquet(source)
        jobs.run_batches(jobs.read_files(spark, source, ev.schema), sink, "late", base)
    kept, late = sink.split()
    late, kept = late.select(F.col("reason").alias("outcome")), kept.select(F.lit("kept").alias("outcome"))
    return late.unionByName(kept).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("st8_replay", f"""WITH {ALERTS} SELECT fingerprint, ts_started, ts_resolved IS NOT NULL AS closed FROM sig
WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1, 2, 3""")
def st8(spark, sf_dir):
    texts = payload_texts(spark, sf_dir)
    path = run_dir(spark, "retained")
    # The same input delivered twice, as after an outage.
    texts.write.parquet(path)
    texts.write.mode("append").parquet(path)

    def transform(rows):
        good, _ = read_alert_payloads(rows)
        signals = al.alerts_to_signals(al.explode_alerts(good), as_of())
        return signals.select("fingerprint", "ts_started", F.col("ts_resolved").isNotNull().alias("closed"))

    out = jobs.replay(spark, path, "ts", F.lit("2024-01-10").cast("timestamp"), transform, ["fingerprint", "ts_started", "closed"])
    return out.withColumn("ts_started", ntz(F.col("ts_started")))


@query("st9_stream_templates", f"""WITH {TEMPLATES}
SELECT service, md5(template) AS digest, count(*) AS n, min(ts) AS first_seen, max(ts) AS last_seen FROM tp GROUP BY 1, 2""")
def st9(spark, sf_dir):
    at = F.expr("timestamp'2024-01-01' + make_dt_interval(0, 0, cast(doc_id as int), 0)")
    docs = stream_of(spark, sf_dir, "documents").select(F.col("source").alias("service"), at.alias("ts"), "text")
    base = run_dir(spark, "templates")
    table = jobs.TemplateTable(spark, base)
    jobs.run_batches(tm.split_lines(docs, "text"), table, "templates", base)
    rows = table.templates()
    return rows.select("service", F.md5("template").alias("digest"), "n", ntz(F.col("first_seen")).alias("first_seen"),
                       ntz(F.col("last_seen")).alias("last_seen"))
