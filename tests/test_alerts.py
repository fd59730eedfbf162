import hashlib
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from faultlens.functions.columns import confidence, fingerprint, fold_severity, severity_for, thresholds
from faultlens.operators import alerts as al
from faultlens.sources import kafka
from faultlens.sources.records import load_slis, read_alert_payloads, slis_frame
from faultlens.sources.sinks import signal_records

AS_OF = "2026-04-25 09:14:30"
QUEUE = {
    "version": "4", "status": "resolved", "commonLabels": {"cluster": "lab-7", "team": "mail"},
    "alerts": [
        {"status": "firing", "labels": {"alertname": "Heartbeat", "severity": "info"}},
        {"status": "resolved", "startsAt": "2026-04-25T08:00:00+01:00", "endsAt": "2026-04-25T07:20:30Z",
         "annotations": {"anomaly_promql": "queue_depth > 900"},
         "labels": {"alertname": "MailQueueGrows", "anomaly": "true", "severity": "info", "anomaly_metric": "queue_depth",
                    "queue": "out", "deployment": "relay", "zone": "b"}},
    ],
}


def convert(spark, *payloads):
    texts = spark.createDataFrame([(p if isinstance(p, str) else json.dumps(p),) for p in payloads], "value string")
    good, bad = read_alert_payloads(texts)
    exploded = al.explode_alerts(good)
    return exploded, al.alerts_to_signals(exploded, F.lit(AS_OF).cast("timestamp")), bad


def alert(labels=None, common=None, **fields):
    base = {"alertname": "A", "anomaly": "true", "cluster": "c"} | (labels or {})
    body = {"status": "firing", "labels": {k: v for k, v in base.items() if v is not None},
            "startsAt": "2026-04-25T09:13:30Z"} | fields
    return {"commonLabels": common or {}, "alerts": [body]}


def test_resolved_alert_becomes_one_signal(spark):
    _, signals, bad = convert(spark, QUEUE)
    (s,) = signals.collect()
    matchers = s["metric"]["matchers"]
    expected = hashlib.sha256("|".join([s["detector"], "queue_depth", ",".join(f"{k}={matchers[k]}" for k in sorted(matchers)), "lab-7"]).encode()).hexdigest()[:16]
    got = {
        "fingerprint": s["fingerprint"], "service": s["service"], "namespace": s["namespace"], "matchers": matchers,
        "promql": s["evidence"]["promql"], "severity": s["severity"], "resolved": s["ts_resolved"], "started": s["ts_started"],
        "window": s["evidence"]["window"]["start"], "length": s["values"]["duration_s"], "cluster": s["cluster"],
    }
    assert got == {
        "fingerprint": expected, "service": "relay", "namespace": None, "matchers": {"queue": "out", "deployment": "relay", "zone": "b"},
        "promql": "queue_depth > 900", "severity": "info", "resolved": datetime(2026, 4, 25, 7, 20, 30), "started": datetime(2026, 4, 25, 7),
        "window": datetime(2026, 4, 25, 6, 55), "length": 2 * 3600.0 + 14 * 60 + 30, "cluster": "lab-7",
    }
    assert bad.count() == 0
    (record,) = signal_records(signals).collect()
    body = json.loads(record["value"])
    assert (record["key"], body["fingerprint"], len(body["anomaly_id"])) == (expected, expected, 36)


def test_counters_add_up(spark):
    exploded, _, _ = convert(spark, QUEUE, alert({"alertname": ""}), alert({"cluster": None}))
    (c,) = al.alert_counters(exploded).collect()
    assert c.asDict() == {"received": 4, "filtered": 1, "invalid": 2, "published": 1}


@pytest.mark.parametrize(("payload", "expected"), [
    (alert({"anomaly": "True"}), None),
    (alert({"anomaly": None}), None),
    (alert({"alertname": ""}), None),
    (alert({"cluster": None}), None),
    (alert(startsAt="yesterday"), None),
    (alert({"cluster": None}, {"cluster": "cc"}), {"cluster": "cc", "matchers": {}}),
    (alert({"cluster": ""}, {"cluster": "cc"}), {"cluster": "cc", "matchers": {"cluster": ""}}),
    (alert({"severity": "PAGER"}), {"severity": "critical"}),
    (alert({"severity": "Info"}), {"severity": "info"}),
    (alert({"severity": "p1"}), {"severity": "warning"}),
    (alert(), {"severity": "warning", "metric": "unknown"}),
    (alert(startsAt="0001-01-01T00:00:00Z"), {"ts_started": datetime(2026, 4, 25, 9, 14, 30)}),
    (alert(startsAt=None), {"ts_started": datetime(2026, 4, 25, 9, 14, 30)}),
    (alert(status="resolved", endsAt="2026-04-25T09:14:00Z"), {"ts_resolved": datetime(2026, 4, 25, 9, 14)}),
    (alert(status="resolved", endsAt="0001-01-01T00:00:00Z"), {"ts_resolved": None}),
    (alert(endsAt="2026-04-25T09:14:00Z"), {"ts_resolved": None}),
    (alert({"service": "", "deployment": "d"}), {"service": ""}),
    (alert({"deployment": "d", "proxy": "p"}), {"service": "d"}),
    (alert(annotations={"anomaly_promql": ""}), {"promql": None}),
])
def test_variations(spark, payload, expected):
    rows = convert(spark, payload)[1].collect()
    if expected is None:
        assert rows == []
        return
    (s,) = rows
    flat = s.asDict() | {"matchers": s["metric"]["matchers"], "metric": s["metric"]["name"], "promql": s["evidence"]["promql"]}
    assert {k: flat[k] for k in expected} == expected


def test_bad_payload_goes_to_dead_letters(spark):
    exploded, _, bad = convert(spark, "{not json", QUEUE)
    assert [r["value"] for r in bad.collect()] == ["{not json"] and exploded.count() == 2


@pytest.mark.parametrize(("detector", "metric", "matchers", "cluster", "expected"), [
    ("d", "m", {"k": "v"}, "c", "293c06edd9c89ca5"),
    ("d2", "m", {"k": "v"}, "c", "7e9875589e11a8f3"),
    ("d", "m2", {"k": "v"}, "c", "c441dd5474177adc"),
    ("d", "m", {"k": "v2"}, "c", "a20bc87c3fe7e9fa"),
    ("d", "m", {"k": "v"}, "c2", "ad0261fe986f3908"),
    ("d", "m", {}, "c", "4b8aea9f847fb469"),
    ("d", "m", {"z": "1", "a": "ü", "B": "x"}, "c", None),
    ("d", "m", {"B": "x", "z": "1", "a": "ü"}, "c", None),
])
def test_fingerprint(spark, detector, metric, matchers, cluster, expected):
    text = ",".join(f"{k}={matchers[k]}" for k in sorted(matchers))
    expected = expected or hashlib.sha256(f"{detector}|{metric}|{text}|{cluster}".encode()).hexdigest()[:16]
    df = spark.createDataFrame([(detector, metric, matchers, cluster)], "d string, m string, x map<string,string>, c string")
    assert df.select(fingerprint(F.col("d"), F.col("m"), F.col("x"), F.col("c"))).first()[0] == expected


def test_confidence_and_severity(spark):
    df = spark.createDataFrame([(-0.5,), (-0.55,), (-0.66,), (-0.83,)], "iso double").withColumn("c", confidence(F.col("iso")))
    got = [(round(r["c"], 6), r["s"]) for r in df.withColumn("s", severity_for(F.col("c"), thresholds())).collect()]
    assert got == [(0.401312, None), (0.5, "info"), (0.706822, "warning"), (0.903784, "critical")]
    folded = df.limit(1).select(*[fold_severity(F.lit(w)).alias(w or "none") for w in ("", "Pager", "CRITICAL", "x")]).first()
    assert list(folded) == ["warning", "critical", "critical", "warning"]


def test_validation(spark):
    _, signals, _ = convert(spark, QUEUE)
    good, bad = al.validate_signals(signals.withColumn("confidence", F.lit(1.2)).withColumn("tier", F.lit(3)))
    assert good.count() == 0 and bad.first()["reason"] == "tier,confidence"


def test_slis(spark, tmp_path):
    path = tmp_path / "slis.json"
    path.write_text(json.dumps({"slis": [{"id": "a", "promql": "q", "metric": "m"},
                                         {"id": "b", "promql": "q", "metric": "m", "severity_thresholds": {"0.8": "critical"},
                                          "baseline_window_s": 10, "sample_interval_s": 5, "seasonality_period": 2}]}))
    a, b = load_slis(spark, str(path)).orderBy("id").collect()
    assert (a["baseline_window_s"], a["sample_interval_s"], a["seasonality_period"], len(a["severity_thresholds"])) == (86400, 60, 60, 3)
    assert (b["baseline_window_s"], b["severity_thresholds"][0]["severity"]) == (10, "critical")
    with pytest.raises(KeyError):
        slis_frame(spark, [{"id": "a", "promql": "q"}])


def test_kafka_options():
    assert kafka.connection_options(["a:1", "b:1"], "SASL_SSL", sasl_mechanism="PLAIN") == {
        "kafka.bootstrap.servers": "a:1,b:1", "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN"}
