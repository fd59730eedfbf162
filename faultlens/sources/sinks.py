"""Writers.  File twins of the topics, dead letters, retention and the incident table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultlens.functions.columns import SECOND, from_micros, micros
from faultlens.operators.ordered import balanced, running
from faultlens.sources.manifest import KeyedTable
from faultlens.sources.kafka import LOG_PRODUCER, SIGNAL_PRODUCER, keyed_json

# --- fixed values: topic -> (retention in hours, byte cap per partition) -------
RETENTION = {
    "anomalies.tier1": (168, 10_737_418_240),
    "anomalies.tier2": (168, 10_737_418_240),
    "logs.parsed": (24, 536_870_912_000),
    "logs.dlq": (72, 10_737_418_240),
    "events.k8s": (72, 10_737_418_240),
    "changes": (168, 10_737_418_240),
}
# -----------------------------------------------------------------------------


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def signal_records(signals: DataFrame) -> DataFrame:
    """Key = fingerprint, value = the signal as JSON; gets its random id here.

    ``values`` leaves as a map, so keys that hold no value are still written as null:
    tier 1 writes observed and duration, tier 2 all six.
    """
    v = F.col("values")
    tier1 = F.create_map(F.lit("observed"), v["observed"], F.lit("duration_s"), v["duration_s"])
    every = ["observed", "baseline_mean", "baseline_std", "iso_score", "residual", "duration_s"]
    tier2 = F.create_map(*[x for n in every for x in (F.lit(n), v[n])])
    has_id = "anomaly_id" in signals.columns
    e = F.col("evidence")
    window = F.struct(_iso(e["window"]["start"]).alias("start"), _iso(e["window"]["end"]).alias("end"))
    row = signals.select(
        "schema_version",
        F.col("anomaly_id") if has_id else F.uuid().alias("anomaly_id"),
        "tier", "detector",
        *[_iso(F.col(c)).alias(c) for c in ("ts_detected", "ts_started", "ts_resolved")],
        "fingerprint", "metric", "cluster", "namespace", "service", "severity", "confidence",
        F.when(F.col("tier") == 1, tier1).otherwise(tier2).alias("values"),
        F.struct(e["promql"].alias("promql"), window.alias("window")).alias("evidence"),
        "source_labels", "annotations",
    )
    return keyed_json(row)


MAX_RECORD_BYTES = 1_000_000  #: what a broker takes by default, a little less than its limit of one MiB


def publishable(records: DataFrame, max_bytes: int = MAX_RECORD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Records a broker takes, and those it would refuse, with their reason: no key, no value, or too long."""
    refused = F.col("key").isNull() | F.col("value").isNull() | (F.octet_length("key") + F.octet_length("value") > max_bytes)
    refused = F.coalesce(refused, F.lit(True))
    return records.filter(~refused), records.filter(refused).withColumn("reason", F.lit("publish error"))


def write_signals(signals: DataFrame, options: dict[str, str], topic: str) -> None:
    signal_records(signals).write.format("kafka").options(**options, **SIGNAL_PRODUCER) \
        .option("topic", topic).save()


def write_signal_files(signals: DataFrame, path: str) -> None:
    """File twin of the topic: rows of one fingerprint stay together unless they are very many."""
    signal_records(signals).hint("rebalance", "key").write.mode("append").parquet(path)


def write_dead_letters(bad: DataFrame, path: str, reason: str | None = None) -> None:
    out = bad if reason is None else bad.withColumn("reason", F.lit(reason))
    out.write.mode("append").partitionBy("reason").parquet(path)


def parsed_log_records(logs: DataFrame) -> DataFrame:
    return keyed_json(logs, "service")


def write_parsed_logs(logs: DataFrame, options: dict[str, str], topic: str) -> None:
    parsed_log_records(logs).write.format("kafka").options(**options, **LOG_PRODUCER).option("topic", topic).save()


def write_parsed_log_files(logs: DataFrame, path: str) -> None:
    """File twin, partitioned by date and service for pruning.

    Rebalancing keeps the files few and splits a service that logs far more than others.
    """
    dated = logs.withColumn("date", F.to_date("timestamp"))
    dated.hint("rebalance", "date", "service").write.mode("append") \
        .option("compression", "zstd").partitionBy("date", "service").parquet(path)


def latest_per_key(rows: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Newest row per key; combines on the map side, so key skew is harmless."""
    newest = F.max_by(F.struct(*rows.columns), F.struct(*version))
    return rows.groupBy(*keys).agg(newest.alias("_row")).select("_row.*")


def upsert_incidents(updates: DataFrame, path: str, keys: Sequence[str] = ("incident_id",),
                     version: Sequence[str] = ("updated_at",), buckets: int = 64) -> KeyedTable:
    """Write incidents into the table at ``path``: one row per incident, newest wins, other buckets untouched."""
    table = KeyedTable(updates.sparkSession, path, tuple(keys), tuple(version), buckets)
    table.upsert(updates)
    return table


def expire(rows: DataFrame, ts: str, as_of: Column, retention_h: int, max_bytes: int, size: Column,
           keys: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    """Rows that survive retention: young enough, and among the newest ``max_bytes`` of their key.

    The byte total runs from newest to oldest over chunks of equally many rows, whatever
    the share of one key or one moment.  Rows of equal time go by ``tie``, then by a hash.
    """
    oldest = micros(as_of) - retention_h * 3600 * SECOND
    young = rows.filter(F.col(ts).cast("timestamp") >= from_micros(oldest)) \
        .withColumn("_age", -micros(F.col(ts))).withColumn("_tie", F.xxhash64(*rows.columns))
    order = ["_age", *tie, "_tie"]
    young = balanced(young, list(keys), order)
    total = running(young, list(keys), "_chunk", order, {"_bytes": ("sum", size.cast("long"))})
    return total.filter(F.col("_bytes") <= max_bytes).drop("_age", "_tie", "_chunk", "_bytes")


__all__ = ["RETENTION", "expire", "latest_per_key", "parsed_log_records", "publishable", "signal_records",
           "upsert_incidents", "write_dead_letters", "write_parsed_log_files", "write_parsed_logs",
           "write_signal_files", "write_signals"]
