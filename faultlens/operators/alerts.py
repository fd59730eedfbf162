"""Alert payloads to canonical anomaly signals (tier 1)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultlens.functions.columns import (
    SECOND, bucket, fingerprint, first_non_empty, fold_severity, micros,
)
from faultlens.operators.ordered import framed

# --- fixed values -----------------------------------------------------------
SCHEMA_VERSION = "v1"
ALERT_DETECTOR_PREFIX = "alertmanager:"
UNKNOWN_METRIC = "unknown"
EVIDENCE_LEAD = "5 minutes"
# Labels of which the first one present names the service.
SERVICE_LABELS = ["service", "deployment", "proxy"]
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class AlertLabels:
    """Names of the labels that mark and describe an anomaly alert."""

    flag: str = "anomaly"
    metric: str = "anomaly_metric"
    group: str = "anomaly_group"
    promql: str = "anomaly_promql"

    def scaffolding(self) -> list[str]:
        """Labels that say how the alert was raised, not what it is about."""
        return ["alertname", "severity", self.flag, self.group, self.metric, "prometheus"]


LABELS = AlertLabels()


def explode_alerts(payloads: DataFrame) -> DataFrame:
    """One row per alert with the payload's common labels next to it."""
    others = [c for c in payloads.columns if c not in ("alerts", "commonLabels", "status")]
    return payloads.select(*others, "commonLabels", F.explode("alerts").alias("_a")).select(
        *others,
        "commonLabels",
        F.col("_a.status").alias("status"),
        F.col("_a.labels").alias("labels"),
        F.col("_a.annotations").alias("annotations"),
        F.col("_a.startsAt").alias("startsAt"),
        F.col("_a.endsAt").alias("endsAt"),
    )


def is_flagged(names: AlertLabels = LABELS) -> Column:
    return F.coalesce(F.col("labels")[names.flag], F.lit("")) == "true"


def flagged_only(alerts: DataFrame, names: AlertLabels = LABELS) -> DataFrame:
    return alerts.filter(is_flagged(names))


def resolve_cluster() -> Column:
    return first_non_empty(F.col("labels")["cluster"], F.col("commonLabels")["cluster"])


def _readable(text: Column) -> Column:
    """Absent and empty times are fine (unset); other text has to parse."""
    return first_non_empty(text).isNull() | F.try_to_timestamp(text).isNotNull()


def is_valid() -> Column:
    named = first_non_empty(F.col("labels")["alertname"]).isNotNull()
    times = _readable(F.col("startsAt")) & _readable(F.col("endsAt"))
    return named & resolve_cluster().isNotNull() & times


def matchers(names: AlertLabels = LABELS) -> Column:
    skip = names.scaffolding()
    return F.map_filter("labels", lambda k, v: ~k.isin(skip))


def metric_name(names: AlertLabels = LABELS) -> Column:
    return F.coalesce(first_non_empty(F.col("labels")[names.metric]), F.lit(UNKNOWN_METRIC))


def detector_name() -> Column:
    return F.concat(F.lit(ALERT_DETECTOR_PREFIX), F.col("labels")["alertname"])


def set_time(text: Column) -> Column:
    """A time, with the year-1 placeholder for "not set" as NULL."""
    ts = F.try_to_timestamp(text)
    return F.when(F.year(ts) > 1, ts)


def started_at(as_of: Column) -> Column:
    return F.coalesce(set_time(F.col("startsAt")), as_of)


def resolved_at() -> Column:
    return F.when(F.col("status") == "resolved", set_time(F.col("endsAt")))


def hoisted_service(labels: Column, present_wins: bool = True) -> Column:
    """Tier 1 takes the first label present, even if empty; tier 2 the first non-empty."""
    values = [labels[name] for name in SERVICE_LABELS]
    return F.coalesce(*values) if present_wins else first_non_empty(*values)


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(float(SECOND))


def evidence(promql: Column, start: Column, end: Column) -> Column:
    window = F.struct((start - F.expr(f"INTERVAL {EVIDENCE_LEAD}")).alias("start"), end.alias("end"))
    samples = F.lit(None).cast("array<struct<ts:timestamp,value:double>>")
    return F.struct(promql.alias("promql"), window.alias("window"), samples.alias("samples"))


def _unless_empty(m: Column) -> Column:
    return F.when(F.size(m) > 0, m)


def alerts_to_signals(alerts: DataFrame, as_of: Column | None = None,
                      names: AlertLabels = LABELS) -> DataFrame:
    """Signals of the flagged, valid alerts; a row-by-row projection without shuffle."""
    as_of = F.current_timestamp() if as_of is None else as_of
    good = alerts.filter(is_flagged(names) & is_valid())
    base = good.select(
        "*",
        detector_name().alias("detector"),
        metric_name(names).alias("_metric"),
        matchers(names).alias("_matchers"),
        resolve_cluster().alias("cluster"),
        started_at(as_of).alias("ts_started"),
        resolved_at().alias("ts_resolved"),
    )
    nothing = F.lit(None).cast("double")
    values = F.struct(
        nothing.alias("observed"),
        nothing.alias("baseline_mean"),
        nothing.alias("baseline_std"),
        nothing.alias("iso_score"),
        nothing.alias("residual"),
        seconds_between(F.col("ts_started"), as_of).alias("duration_s"),
    )
    return base.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(1).alias("tier"),
        "detector",
        as_of.alias("ts_detected"),
        "ts_started",
        "ts_resolved",
        fingerprint(F.col("detector"), F.col("_metric"), F.col("_matchers"), F.col("cluster")).alias("fingerprint"),
        F.struct(F.col("_metric").alias("name"), F.col("_matchers").alias("matchers")).alias("metric"),
        "cluster",
        F.col("_matchers")["namespace"].alias("namespace"),
        hoisted_service(F.col("_matchers")).alias("service"),
        fold_severity(F.coalesce(F.col("labels")["severity"], F.lit(""))).alias("severity"),
        F.lit(1.0).alias("confidence"),
        values.alias("values"),
        evidence(first_non_empty(F.col("annotations")[names.promql]), F.col("ts_started"), as_of).alias("evidence"),
        _unless_empty(F.col("labels")).alias("source_labels"),
        _unless_empty(F.col("annotations")).alias("annotations"),
    )


def outcome(names: AlertLabels = LABELS, failed: Column | None = None) -> Column:
    """What becomes of an alert: filtered, invalid, published, or a publish error where ``failed`` holds."""
    out = F.when(~is_flagged(names), F.lit("filtered")).when(~is_valid(), F.lit("invalid"))
    if failed is not None:
        out = out.when(failed, F.lit("publish_errors"))
    return out.otherwise(F.lit("published"))


def counter_columns(names: AlertLabels = LABELS, failed: Column | None = None) -> list[Column]:
    """Aggregates for ``groupBy().agg`` or ``DataFrame.observe``; received is the sum of the others.

    Publish errors are counted where ``failed`` is given.
    """
    result = outcome(names, failed)
    words = ("filtered", "invalid", "published", *(("publish_errors",) if failed is not None else ()))
    return [F.count(F.lit(1)).alias("received"), *[F.coalesce(F.sum((result == word).cast("long")), F.lit(0)).alias(word) for word in words]]


def alert_counters(alerts: DataFrame, names: AlertLabels = LABELS, failed: Column | None = None) -> DataFrame:
    return alerts.agg(*counter_columns(names, failed))


def invalid_ratio(alerts: DataFrame, at: str, window_s: int = 900, limit: float = 0.05,
                  names: AlertLabels = LABELS, step_s: int = 60) -> DataFrame:
    """Minutes at which invalid/received over the window exceeds the limit.

    Alerts are counted per minute first; only these counts enter the sliding sums.
    """
    slot = (bucket(micros(F.col(at)), step_s * SECOND) * (step_s * SECOND)).alias("slot_us")
    counts = alerts.groupBy(slot).agg(
        F.count(F.lit(1)).alias("_n"), F.sum((outcome(names) == "invalid").cast("long")).alias("_bad"))
    sums = framed(counts, [], "slot_us", {"received": F.sum("_n"), "invalid": F.sum("_bad")},
                  before_us=(window_s - step_s) * SECOND)
    ratio = F.col("invalid") / F.col("received")
    return sums.select("slot_us", "received", "invalid", ratio.alias("ratio")).filter(F.col("ratio") > limit)


def publish_error_rate(publishes: DataFrame, at: str, failed: Column, window_s: int = 300,
                       step_s: int = 60) -> DataFrame:
    """Minutes with a publish failure in the window before them."""
    slot = (bucket(micros(F.col(at)), step_s * SECOND) * (step_s * SECOND)).alias("slot_us")
    counts = publishes.groupBy(slot).agg(F.sum(failed.cast("long")).alias("_bad"))
    sums = framed(counts, [], "slot_us", {"errors": F.sum("_bad")}, before_us=(window_s - step_s) * SECOND)
    return sums.select("slot_us", "errors", (F.col("errors") / float(window_s)).alias("rate")).filter("errors > 0")


def violations() -> Column:
    """Names of the broken rules of a signal row, as an array."""
    conf = F.col("confidence")
    rules = {
        "schema_version": F.col("schema_version").isNull(),
        "tier": F.coalesce(~F.col("tier").isin(1, 2), F.lit(True)),
        "detector": F.col("detector").isNull(),
        "ts_detected": F.col("ts_detected").isNull(),
        "ts_started": F.col("ts_started").isNull(),
        "fingerprint": F.col("fingerprint").isNull(),
        "metric": F.col("metric.name").isNull(),
        "cluster": F.col("cluster").isNull(),
        "severity": F.col("severity").isNull(),
        "confidence": F.coalesce(~conf.between(0.0, 1.0) | F.isnan(conf), F.lit(True)),
    }
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))


def validate_signals(signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good signals, and the bad ones with the reason they go to dead letters."""
    checked = signals.withColumn("_bad", violations())
    good = checked.filter(F.size("_bad") == 0).drop("_bad")
    bad = checked.filter(F.size("_bad") > 0).withColumn("reason", F.concat_ws(",", "_bad")).drop("_bad")
    return good, bad


def dedupe_signals(signals: DataFrame) -> DataFrame:
    """First signal of each (fingerprint, start, resolved or not).

    A minimum per key combines on the map side, so an alert repeated millions of
    times costs one row per task.  The resolved flag keeps the closing message,
    which carries the same fingerprint.
    """
    row = F.struct(*signals.columns)
    order = F.struct("ts_detected", "anomaly_id")
    return (
        signals.groupBy("fingerprint", "ts_started", F.col("ts_resolved").isNotNull().alias("_closed"))
        .agg(F.min_by(row, order).alias("_first"))
        .select("_first.*")
    )


def stitch_episodes(signals: DataFrame) -> DataFrame:
    """Firing and resolved messages of one episode as one row."""
    return signals.groupBy("fingerprint", "ts_started").agg(
        F.max("ts_resolved").alias("ts_resolved"), F.count(F.lit(1)).alias("n_emissions"))


def rollup_signals(signals: DataFrame) -> DataFrame:
    return signals.rollup("cluster", "namespace", "service", "severity").agg(F.count(F.lit(1)).alias("n"))


def incident_numbers(incidents: DataFrame, day: str, chunk: str, order: list[str]) -> DataFrame:
    """Add ``incident_id`` = INC-<date>-<running number of the day, four digits>."""
    from faultlens.operators.ordered import numbered

    out = numbered(incidents, [day], chunk, order, "_seq")
    digits = F.when(F.length(F.col("_seq").cast("string")) < 4, F.lpad(F.col("_seq").cast("string"), 4, "0")) \
        .otherwise(F.col("_seq").cast("string"))
    return out.withColumn("incident_id", F.concat(F.lit("INC-"), F.date_format(day, "yyyy-MM-dd"), F.lit("-"), digits)).drop("_seq")


