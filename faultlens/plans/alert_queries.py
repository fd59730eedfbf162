"""Tier 1: payloads built from the events table, parsed back and turned into signals."""

from pyspark.sql import functions as F

from faultlens.functions.columns import fingerprint, fold_severity, kv_text, ntz
from faultlens.operators import alerts as al
from faultlens.operators.alerts import LABELS
from faultlens.plans import twins
from faultlens.plans.registry import query
from faultlens.session import run_dir
from faultlens.sources.records import read_alert_payloads
from faultlens.sources.sinks import signal_records, write_dead_letters

AS_OF = "2024-02-01 00:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def payload_texts(spark, sf_dir):
    """One payload per event: an alert that varies with the row, and an unflagged one."""
    ev = twins.events(spark, sf_dir)
    k, user = F.col("k"), F.col("user_id")

    def tag(prefix, number):
        return F.concat(F.lit(prefix), number.cast("string"))

    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    later = F.date_format(F.col("ts") + F.expr("INTERVAL 10 MINUTES"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    zero = F.lit("0001-01-01T00:00:00Z")
    kind = F.col("event_type")
    labels = {
        "alertname": F.when(k % 10 == 0, "").otherwise(F.concat(F.lit("Alert_"), kind)),
        LABELS.flag: F.when(kind.isin("error", "purchase"), "true").when(kind == "view", "True"),
        "severity": F.when(k % 6 == 1, "critical").when(k % 6 == 2, "PAGER").when(k % 6 == 3, "Info")
        .when(k % 6 == 4, "p1").when(k % 6 == 5, ""),
        LABELS.metric: F.when(k % 3 != 0, tag("metric_", k % 4)),
        "cluster": F.when(k % 4 == 1, "").when(k % 4 > 1, tag("c", user % 3)),
        "namespace": F.when(k % 5 != 0, tag("ns", user % 4)),
        "service": F.when(k % 8 == 1, "").when(k % 8 != 2, tag("svc", user % 10)),
        "deployment": F.when(k % 2 == 0, tag("dep", user % 10)),
    }
    first = F.struct(
        F.when(F.col("event_id") % 2 == 0, "firing").otherwise("resolved").alias("status"),
        F.struct(*[c.alias(n) for n, c in labels.items()]).alias("labels"),
        F.struct(F.when(k % 9 == 0, "").when(k % 9 != 1, F.concat(F.lit("rate(x["), k.cast("string"), F.lit("m])")))
                 .alias(LABELS.promql)).alias("annotations"),
        F.when(k % 11 == 0, zero).otherwise(iso).alias("startsAt"),
        F.when(k % 13 == 0, zero).otherwise(later).alias("endsAt"),
    )
    second = F.struct(
        F.lit("firing").alias("status"),
        F.struct(*[F.lit({"alertname": "Other", "severity": "warning"}.get(n)).cast("string").alias(n) for n in labels])
        .alias("labels"),
        F.struct(F.lit(None).cast("string").alias(LABELS.promql)).alias("annotations"),
        F.lit(None).cast("string").alias("startsAt"),
        F.lit(None).cast("string").alias("endsAt"),
    )
    payload = F.to_json(F.struct(
        F.lit("4").alias("version"),
        F.lit("firing").alias("status"),
        F.struct(F.when(user % 2 == 0, tag("common", user % 3)).alias("cluster")).alias("commonLabels"),
        F.array(first, second).alias("alerts"),
    ))
    value = F.when(F.col("event_id") % 97 == 0, '{"version":"4","alerts":[').otherwise(payload)
    return ev.select("event_id", "ts", value.alias("value"))


def parsed_alerts(spark, sf_dir):
    good, _ = read_alert_payloads(payload_texts(spark, sf_dir))
    return al.explode_alerts(good.select("event_id", "ts", "commonLabels", "alerts"))


def plain_signals(spark, sf_dir):
    """Signals; the event id rides along as an annotation."""
    row_id = F.create_map(F.lit("event_id"), F.col("event_id").cast("string"))
    rows = parsed_alerts(spark, sf_dir).withColumn("annotations", F.map_concat("annotations", row_id))
    signals = al.alerts_to_signals(rows, as_of())
    return signals.withColumn("anomaly_id", F.col("annotations")["event_id"].cast("long"))


ALERTS = twins.EVENTS + """,
al0 AS (
  SELECT event_id, us, ts, user_id, event_type, k, value,
    CASE WHEN k % 10 = 0 THEN '' ELSE 'Alert_' || event_type END AS alertname,
    event_type IN ('error', 'purchase') AS flagged,
    CASE k % 6 WHEN 1 THEN 'critical' WHEN 2 THEN 'critical' WHEN 3 THEN 'info' ELSE 'warning' END AS severity,
    CASE WHEN k % 3 = 0 THEN 'unknown' ELSE 'metric_' || (k % 4) END AS metric,
    CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'c' || (user_id % 3) END AS cluster_label,
    CASE WHEN user_id % 2 = 0 THEN 'common' || (user_id % 3) END AS common_cluster,
    CASE WHEN k % 5 <> 0 THEN 'ns' || (user_id % 4) END AS namespace,
    CASE k % 8 WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'svc' || (user_id % 10) END AS svc,
    CASE WHEN k % 2 = 0 THEN 'dep' || (user_id % 10) END AS dep,
    CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE 'rate(x[' || k || 'm])' END AS promql,
    CASE WHEN event_id % 2 = 0 THEN 'firing' ELSE 'resolved' END AS status,
    CASE WHEN k % 11 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE ts END AS ts_started,
    CASE WHEN event_id % 2 <> 0 AND k % 13 <> 0 THEN ts + INTERVAL 10 MINUTE END AS ts_resolved
  FROM ev WHERE event_id % 97 <> 0
),
al1 AS (
  SELECT *, coalesce(nullif(cluster_label, ''), common_cluster) AS cluster, coalesce(svc, dep) AS service,
    concat_ws(',', 'cluster=' || cluster_label, 'deployment=' || dep, 'namespace=' || namespace, 'service=' || svc) AS matchers
  FROM al0
),
al AS (SELECT *, alertname <> '' AND cluster IS NOT NULL AS valid FROM al1),
sig AS (
  SELECT *, 'alertmanager:' || alertname AS detector,
    substr(sha256('alertmanager:' || alertname || '|' || metric || '|' || matchers || '|' || cluster), 1, 16) AS fingerprint,
    (epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us(ts_started)) / 1000000.0::DOUBLE AS duration_s
  FROM al WHERE flagged AND valid
)"""


# Both alerts of every payload.
BOTH = ALERTS + """,
two AS (
  SELECT event_id, 1 AS nth, severity, cluster, matchers, metric, alertname, ts_started, ts_resolved, namespace, service, svc, dep FROM al
  UNION ALL SELECT event_id, 2, 'warning', common_cluster, '', 'unknown', 'Other', TIMESTAMP '2024-02-01 00:00:00', NULL, NULL, NULL, NULL, NULL FROM al
)"""


def nth():
    """Which of a payload's alerts a row is."""
    return F.when(F.col("labels")["alertname"] == "Other", 2).otherwise(1).alias("nth")


@query("src1_read_alert_payloads", f"""WITH {twins.EVENTS}
SELECT event_id % 97 <> 0 AS readable, count(*) AS n, CAST(sum(CASE WHEN event_id % 97 <> 0 THEN 2 ELSE 0 END) AS BIGINT) AS n_alerts
FROM ev GROUP BY 1""")
def src1(spark, sf_dir):
    good, bad = read_alert_payloads(payload_texts(spark, sf_dir))
    both = good.select(F.lit(True).alias("readable"), F.size("alerts").alias("n")).unionByName(
        bad.select(F.lit(False).alias("readable"), F.lit(0).alias("n")))
    return both.groupBy("readable").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("n_alerts"))


@query("al1_explode_alerts", f"""WITH {ALERTS}
SELECT event_id, alertname, status, common_cluster FROM al
UNION ALL SELECT event_id, 'Other', 'firing', common_cluster FROM al""")
def al1(spark, sf_dir):
    return parsed_alerts(spark, sf_dir).select(
        "event_id", F.col("labels")["alertname"].alias("alertname"), "status",
        F.col("commonLabels")["cluster"].alias("common_cluster"))


@query("al2_flagged_only", f"WITH {ALERTS} SELECT event_id, alertname FROM al WHERE flagged")
def al2(spark, sf_dir):
    return al.flagged_only(parsed_alerts(spark, sf_dir)).select("event_id", F.col("labels")["alertname"].alias("alertname"))


@query("al3_valid_alert", f"WITH {ALERTS} SELECT event_id, valid FROM al WHERE flagged")
def al3(spark, sf_dir):
    return al.flagged_only(parsed_alerts(spark, sf_dir)).select("event_id", al.is_valid().alias("valid"))


@query("al4_resolve_cluster", f"WITH {BOTH} SELECT event_id, nth, cluster FROM two")
def al4(spark, sf_dir):
    return parsed_alerts(spark, sf_dir).select("event_id", nth(), al.resolve_cluster().alias("cluster"))


@query("al5_normalise_severity", f"""WITH {BOTH}
SELECT 'alert' AS origin, severity, count(*) AS n FROM two GROUP BY 2
UNION ALL
SELECT 'order', CASE lower(substr(o_orderpriority, 3)) WHEN 'info' THEN 'info' WHEN 'critical' THEN 'critical'
  WHEN 'pager' THEN 'critical' ELSE 'warning' END, count(*) FROM orders GROUP BY 2""")
def al5(spark, sf_dir):
    mine = parsed_alerts(spark, sf_dir).select(
        F.lit("alert").alias("origin"), fold_severity(F.coalesce(F.col("labels")["severity"], F.lit(""))).alias("severity"))
    orders = twins.table(spark, sf_dir, "orders").select(
        F.lit("order").alias("origin"), fold_severity(F.expr("substr(o_orderpriority, 3)")).alias("severity"))
    return mine.unionByName(orders).groupBy("origin", "severity").agg(F.count(F.lit(1)).alias("n"))


@query("al6_matchers", f"WITH {BOTH} SELECT event_id, nth, matchers FROM two")
def al6(spark, sf_dir):
    return parsed_alerts(spark, sf_dir).select("event_id", nth(), kv_text(al.matchers()).alias("matchers"))


@query("al7_metric_name", f"WITH {BOTH} SELECT event_id, nth, metric, 'alertmanager:' || alertname AS detector FROM two")
def al7(spark, sf_dir):
    return parsed_alerts(spark, sf_dir).select(
        "event_id", nth(), al.metric_name().alias("metric"), al.detector_name().alias("detector"))


@query("al8_fingerprint", f"WITH {ALERTS} SELECT event_id, fingerprint FROM sig")
def al8(spark, sf_dir):
    rows = al.flagged_only(parsed_alerts(spark, sf_dir)).filter(al.is_valid())
    return rows.select("event_id", fingerprint(
        al.detector_name(), al.metric_name(), al.matchers(), al.resolve_cluster()).alias("fingerprint"))


@query("al9_alert_times", f"WITH {BOTH} SELECT event_id, nth, ts_started, ts_resolved FROM two")
def al9(spark, sf_dir):
    return parsed_alerts(spark, sf_dir).select(
        "event_id", nth(), ntz(al.started_at(as_of())).alias("ts_started"), ntz(al.resolved_at()).alias("ts_resolved"))


@query("al10_hoist", f"""WITH {BOTH}
SELECT event_id, nth, namespace, service AS tier1_service, coalesce(nullif(svc, ''), dep) AS tier2_service FROM two""")
def al10(spark, sf_dir):
    m = al.matchers()
    return parsed_alerts(spark, sf_dir).select(
        "event_id", nth(), m["namespace"].alias("namespace"), al.hoisted_service(m).alias("tier1_service"),
        al.hoisted_service(m, present_wins=False).alias("tier2_service"))


@query("al11_evidence", f"""WITH {ALERTS}
SELECT event_id, promql, ts_started - INTERVAL 5 MINUTE AS window_start, TIMESTAMP '2024-02-01 00:00:00' AS window_end,
  duration_s FROM sig""")
def al11(spark, sf_dir):
    e = F.col("evidence")
    return plain_signals(spark, sf_dir).select(
        F.col("anomaly_id").alias("event_id"), e["promql"].alias("promql"),
        ntz(e["window"]["start"]).alias("window_start"), ntz(e["window"]["end"]).alias("window_end"),
        F.col("values.duration_s").alias("duration_s"))


@query("al12_alerts_to_signals", f"""WITH {ALERTS}
SELECT event_id AS anomaly_id, 'v1' AS schema_version, 1 AS tier, detector, fingerprint, metric, matchers, cluster, namespace,
  service, severity, 1.0::DOUBLE AS confidence, ts_started, ts_resolved, duration_s, promql FROM sig""")
def al12(spark, sf_dir):
    return plain_signals(spark, sf_dir).select(
        "anomaly_id", "schema_version", "tier", "detector", "fingerprint", F.col("metric.name").alias("metric"),
        kv_text(F.col("metric.matchers")).alias("matchers"), "cluster", "namespace", "service", "severity", "confidence",
        ntz(F.col("ts_started")).alias("ts_started"), ntz(F.col("ts_resolved")).alias("ts_resolved"),
        F.col("values.duration_s").alias("duration_s"), F.col("evidence.promql").alias("promql"))


@query("al13_alert_counters", f"""WITH {ALERTS}
SELECT 2 * count(*) AS received, count(*) + count(*) FILTER (NOT flagged) AS filtered,
  count(*) FILTER (flagged AND NOT valid) AS invalid, count(*) FILTER (flagged AND valid AND value <= 150) AS published,
  count(*) FILTER (flagged AND valid AND value > 150) AS publish_errors FROM al""")
def al13(spark, sf_dir):
    """Signals of large values stand for those that cannot be published."""
    ev = twins.events(spark, sf_dir).select("event_id", "value")
    return al.alert_counters(parsed_alerts(spark, sf_dir).join(ev, "event_id", "left"), failed=F.coalesce(F.col("value") > 150, F.lit(False)))


@query("al14_invalid_ratio", f"""WITH {ALERTS},
slot AS (SELECT us // 60000000 * 60000000 AS slot_us, 2 * count(*) AS n, count(*) FILTER (flagged AND NOT valid) AS bad
         FROM al GROUP BY 1),
run AS (SELECT slot_us, CAST(sum(n) OVER w AS BIGINT) AS received, CAST(sum(bad) OVER w AS BIGINT) AS invalid FROM slot
        WINDOW w AS (ORDER BY slot_us RANGE BETWEEN 840000000 PRECEDING AND CURRENT ROW))
SELECT slot_us, received, invalid, round(invalid / received::DOUBLE, 6) AS ratio FROM run WHERE invalid / received::DOUBLE > 0.05""")
def al14(spark, sf_dir):
    return al.invalid_ratio(parsed_alerts(spark, sf_dir), "ts").withColumn("ratio", F.round("ratio", 6))


@query("al14_publish_error_rate", f"""WITH {ALERTS},
slot AS (SELECT us // 60000000 * 60000000 AS slot_us, count(*) FILTER (value > 150) AS bad FROM sig GROUP BY 1),
run AS (SELECT slot_us, CAST(sum(bad) OVER (ORDER BY slot_us RANGE BETWEEN 240000000 PRECEDING AND CURRENT ROW) AS BIGINT) AS errors FROM slot)
SELECT slot_us, errors, round(errors / 300.0::DOUBLE, 6) AS rate FROM run WHERE errors > 0""")
def al14b(spark, sf_dir):
    ev = twins.events(spark, sf_dir).select("event_id", "value")
    rows = al.flagged_only(parsed_alerts(spark, sf_dir)).filter(al.is_valid()).join(ev, "event_id")
    return al.publish_error_rate(rows, "ts", F.col("value") > 150).withColumn("rate", F.round("rate", 6))


@query("al15_validate_signals", f"""WITH {ALERTS},
v AS (SELECT CASE WHEN value > 100 AND k % 7 = 0 THEN 'tier,confidence' WHEN value > 100 THEN 'confidence'
        WHEN k % 7 = 0 THEN 'tier' ELSE 'good' END AS reason
      FROM sig)
SELECT reason, count(*) AS n FROM v GROUP BY 1""")
def al15(spark, sf_dir):
    ev = twins.events(spark, sf_dir).select(F.col("event_id").alias("anomaly_id"), "value", "k")
    rows = plain_signals(spark, sf_dir).join(ev, "anomaly_id") \
        .withColumn("confidence", F.col("value") / 100).withColumn("tier", F.when(F.col("k") % 7 == 0, 3).otherwise(F.col("tier")))
    good, bad = al.validate_signals(rows)
    return good.select(F.lit("good").alias("reason")).unionByName(bad.select("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


@query("ag1_dedupe_by_fingerprint", f"""WITH {ALERTS}
SELECT min(event_id) AS anomaly_id, fingerprint, ts_started, ts_resolved IS NOT NULL AS closed
FROM sig GROUP BY fingerprint, ts_started, ts_resolved IS NOT NULL""")
def ag1(spark, sf_dir):
    return al.dedupe_signals(plain_signals(spark, sf_dir)).select(
        "anomaly_id", "fingerprint", ntz(F.col("ts_started")).alias("ts_started"),
        F.col("ts_resolved").isNotNull().alias("closed"))


@query("ag2_stitch_episodes", f"""WITH {ALERTS}
SELECT fingerprint, ts_started, max(ts_resolved) AS ts_resolved, count(*) AS n_emissions FROM sig GROUP BY 1, 2""")
def ag2(spark, sf_dir):
    return al.stitch_episodes(plain_signals(spark, sf_dir)).select(
        "fingerprint", ntz(F.col("ts_started")).alias("ts_started"), ntz(F.col("ts_resolved")).alias("ts_resolved"), "n_emissions")


@query("ag6_incident_ids", """SELECT o_orderkey,
  'INC-' || strftime(o_orderdate, '%Y-%m-%d') || '-' || lpad(CAST(row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS VARCHAR), 4, '0') AS incident_id
FROM orders""")
def ag6(spark, sf_dir):
    orders = twins.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    chunked = orders.withColumn("chunk", F.floor(F.col("o_orderkey") / 100_000))
    return al.incident_numbers(chunked, "day", "chunk", ["o_orderkey"]).select("o_orderkey", "incident_id")


@query("ag7_rollup_signals", f"""WITH {ALERTS}
SELECT cluster, namespace, service, severity, count(*) AS n FROM sig GROUP BY ROLLUP (cluster, namespace, service, severity)""")
def ag7(spark, sf_dir):
    return al.rollup_signals(plain_signals(spark, sf_dir))


@query("snk1_write_signals", f"""WITH {ALERTS}
SELECT event_id AS anomaly_id, fingerprint AS "key", fingerprint, round(duration_s, 3) AS duration_s, true AS has_null_observed,
  ts_resolved IS NOT NULL AS has_resolved FROM sig""")
def snk1(spark, sf_dir):
    v = F.col("value")
    return signal_records(plain_signals(spark, sf_dir)).select(
        F.get_json_object(v, "$.anomaly_id").cast("long").alias("anomaly_id"), "key",
        F.get_json_object(v, "$.fingerprint").alias("fingerprint"),
        F.round(F.get_json_object(v, "$.values.duration_s").cast("double"), 3).alias("duration_s"),
        v.contains('"observed":null').alias("has_null_observed"),
        v.contains('"ts_resolved":').alias("has_resolved"))


@query("snk2_write_dead_letters", f"""WITH {twins.EVENTS}
SELECT 'invalid json' AS reason, count(*) AS n, sum(event_id)::BIGINT AS id_sum FROM ev WHERE event_id % 97 = 0""")
def snk2(spark, sf_dir):
    _, bad = read_alert_payloads(payload_texts(spark, sf_dir))
    path = run_dir(spark, "dead-letters")
    write_dead_letters(bad, path)
    return spark.read.parquet(path).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))
