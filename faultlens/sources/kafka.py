"""Option maps and projections for the Kafka connector.

The connector jar is not part of this repository.  File sources with the same
columns (``topic``, ``value``, ``headers``) stand in for it in tests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def connection_options(brokers: Sequence[str], protocol: str = "PLAINTEXT", **client: str) -> dict[str, str]:
    """Options of the connector; the Kafka client itself checks protocol, mechanism and credentials.

    Further client settings are named with underscores, as in ``sasl_mechanism="PLAIN"``.
    """
    settings = {"bootstrap_servers": ",".join(brokers), "security_protocol": protocol, **client}
    return {f"kafka.{name.replace('_', '.')}": value for name, value in settings.items()}


# Signals must not be lost; parsed logs may be.
SIGNAL_PRODUCER = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.compression.type": "zstd",
    "kafka.batch.size": str(16 * 1024),
    "kafka.linger.ms": "50",
}
LOG_PRODUCER = {"kafka.acks": "1", "kafka.compression.type": "zstd"}


def read_topics(spark: SparkSession, options: dict[str, str], topics: Sequence[str] | None = None,
                pattern: str | None = None, streaming: bool = True) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**options)
    reader = reader.option("includeHeaders", "true")
    if topics is not None:
        reader = reader.option("subscribe", ",".join(topics))
    if pattern is not None:
        reader = reader.option("subscribePattern", pattern)
    return reader.load()


def keyed_json(df: DataFrame, key: str = "fingerprint") -> DataFrame:
    """Kafka records: the key column and the whole row as JSON."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
