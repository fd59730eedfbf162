"""Timelines of workloads and incidents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultlens.functions.columns import bucket, micros
from faultlens.operators.ordered import HOUR, numbered


def k8s_timeline(events: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str], chunk_us: int = HOUR) -> DataFrame:
    """Add each event's ``position`` in the history of its workload."""
    rows = events.withColumn("_us", micros(F.col(ts))).withColumn("_chunk", bucket(F.col("_us"), chunk_us))
    return numbered(rows, keys, "_chunk", ["_us", *tie], "position").drop("_us", "_chunk")
