"""Equi, look-up, interval and fusing joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultlens.functions.columns import first_non_empty
from faultlens.operators.ordered import asof_join, interval_join, islands


def join_dimension(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join to a table that is usually small, without forcing it.

    There is no broadcast hint on purpose: Spark broadcasts the side only while its
    size, measured at run time, is below ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
    beyond that both sides shuffle and adaptive execution splits skewed partitions.
    """
    return big.join(small, list(on), how)


def allowlist_semi_join(logs: DataFrame, topics: DataFrame, departments: Sequence[str] | None = None,
                        topic: str = "source_topic", department: str = "department") -> DataFrame:
    """Logs of listed topics, and of the given departments when those are named."""
    out = logs if departments is None else logs.filter(F.col(department).isin(list(departments)))
    return join_dimension(out, topics.select(topic).distinct(), [topic], "left_semi")


def cluster_lookup(logs: DataFrame, patterns: DataFrame, host: str = "host",
                   given: str = "given_cluster") -> DataFrame:
    """Set ``cluster``: the given one, else the longest host-name prefix in ``patterns(prefix, cluster)``.

    Prefixes of each distinct host are matched by equality, so no pattern is
    tested against every row.
    """
    hosts = logs.filter(first_non_empty(F.col(given)).isNull()).select(host).distinct()
    prefixes = hosts.withColumn("_n", F.explode(F.sequence(F.lit(1), F.greatest(F.length(host), F.lit(1))))) \
        .withColumn("prefix", F.expr(f"substring(`{host}`, 1, _n)"))
    found = (
        prefixes.join(patterns.select("prefix", F.col("cluster").alias("_cluster")), "prefix")
        .groupBy(host)
        .agg(F.max_by("_cluster", F.struct("_n", "_cluster")).alias("_found"))
    )
    out = join_dimension(logs, found, [host], "left")
    return out.withColumn("cluster", F.coalesce(first_non_empty(F.col(given)), F.col("_found"))).drop("_found")


def fuse_tiers(tier1: DataFrame, tier2: DataFrame,
               keys: Sequence[str] = ("metric", "cluster", "namespace", "service")) -> DataFrame:
    """Merge detections of both tiers whose windows overlap on the same subject.

    Input rows need the keys, ``anomaly_id``, ``start_us`` and ``end_us``.  The detector
    is part of a fingerprint, so fingerprints cannot match across tiers; the subject
    columns do, NULLs included.  One row per merged episode.
    """
    cols = [*keys, "anomaly_id", "start_us", "end_us"]
    both = tier1.select(*cols, F.lit(1).alias("tier")).unionByName(
        tier2.select(*cols, F.lit(2).alias("tier")))
    groups = islands(both, list(keys), "start_us", "end_us", ["tier", "anomaly_id"])
    return groups.groupBy(*keys, "_island").agg(
        F.min("start_us").alias("start_us"),
        F.max("end_us").alias("end_us"),
        F.sum((F.col("tier") == 1).cast("long")).alias("n_tier1"),
        F.sum((F.col("tier") == 2).cast("long")).alias("n_tier2"),
    ).drop("_island")


def embed_worklist(items: DataFrame, embedded: DataFrame, on: Sequence[str]) -> DataFrame:
    """Items that have no embedding yet."""
    return items.join(embedded.select(*on).distinct(), list(on), "left_anti")


def candidate_diffs(causes: DataFrame, diffs: DataFrame, on: str = "change_event_id") -> DataFrame:
    return causes.join(diffs.select(on, "diff_summary"), on, "left")


def after_deploy(first_seen: DataFrame, changes: DataFrame, key: str = "service",
                 seen_us: str = "first_us", change_us: str = "change_us",
                 change_id: str = "change_id") -> DataFrame:
    """Latest change of the service at or before the first sight of a template."""
    marked = changes.withColumn("_at", F.col(change_us))
    return asof_join(first_seen, marked, [key], seen_us, "_at", [change_us, change_id])


def sli_enrich(samples: DataFrame, slis: DataFrame) -> DataFrame:
    """Attach metric, promql and detector settings of the SLI; unknown SLIs drop out."""
    dims = slis.withColumnRenamed("id", "sli_id")
    return join_dimension(samples.drop(*[c for c in dims.columns if c != "sli_id"]), dims, ["sli_id"], "inner")


__all__ = [
    "after_deploy", "allowlist_semi_join", "candidate_diffs", "cluster_lookup", "embed_worklist",
    "fuse_tiers", "interval_join", "join_dimension", "sli_enrich",
]
