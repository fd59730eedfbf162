"""Readers: JSON payloads, query answers, SLI lists, logs, cluster events, webhooks.

Every reader has the same shape: a frame with a text column goes in, typed columns
come out.  The text may come from files (``spark.read.text`` / ``readStream.text``),
from Kafka, or from a column of another table.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultlens import schemas
from faultlens.functions.columns import DEFAULT_THRESHOLDS, first_non_empty


def with_parsed(df: DataFrame, value: Column, schema: T.StructType, name: str = "_doc") -> DataFrame:
    """Add the parsed JSON of a text; NULL unless the text as a whole fits the schema.

    The generator keeps the parsed struct in one place: a plain column would be
    copied into every filter and field read above it and parsed again in each.
    """
    with_flag = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType(), True)])
    doc = F.from_json(value, with_flag, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = df.select("*", F.explode(F.array(doc)).alias(name))
    return out.withColumn(name, F.when(F.col(name)["_corrupt"].isNull(), F.col(name)))


def read_alert_payloads(texts: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Payload rows, and the texts that are no payload (whole payload rejected)."""
    keep = [c for c in texts.columns if c != value]
    docs = with_parsed(texts, F.col(value), schemas.ALERT_PAYLOAD)
    fields = [F.col(f"_doc.{f}").alias(f) for f in schemas.ALERT_PAYLOAD.fieldNames()]
    good = docs.filter(F.col("_doc").isNotNull()).select(*keep, *fields)
    bad = docs.filter(F.col("_doc").isNull()).drop("_doc").withColumn("reason", F.lit("invalid json"))
    return good, bad


def samples_from_query_results(answers: DataFrame, slis: DataFrame, value: str = "value") -> DataFrame:
    """One raw row per result series of a successful answer: labels, time and value text.

    ``clean_samples`` turns these into samples.
    """
    from faultlens.operators.joins import sli_enrich

    docs = with_parsed(answers, F.col(value), schemas.QUERY_RESULT)
    rows = docs.filter("_doc.status = 'success'").select("sli_id", F.explode("_doc.data.result").alias("_r"))
    empty = F.create_map().cast(schemas.STRING_MAP)
    rows = rows.select("sli_id", F.coalesce("_r.metric", empty).alias("labels"), F.col("_r.value").alias("raw"))
    return sli_enrich(rows, slis.select("id", "metric", "promql"))


def load_slis(spark: SparkSession, path: str) -> DataFrame:
    """SLI list from YAML (if a YAML reader is installed) or JSON: ``{"slis": [...]}``."""
    text = Path(path).read_text()
    try:
        raw = json.loads(text)
    except json.JSONDecodeError:
        import yaml

        raw = yaml.safe_load(text)
    return slis_frame(spark, raw.get("slis", []))


def slis_frame(spark: SparkSession, items: list[dict]) -> DataFrame:
    """SLIs with the defaults filled in; id, promql and metric are required."""
    rows = []
    for item in items:
        given = item.get("severity_thresholds")
        pairs = DEFAULT_THRESHOLDS if given is None else [(float(k), v) for k, v in given.items()]
        rows.append((
            item["id"], item["promql"], item["metric"], sorted(pairs),
            int(item.get("baseline_window_s", 86_400)),
            int(item.get("sample_interval_s", 60)),
            int(item.get("seasonality_period", 60)),
        ))
    return spark.createDataFrame(rows, schemas.SLI)


def slis_with_defaults(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SLI rows of a table with defaults filled in, and the rows lacking a required field."""
    from faultlens.functions.columns import thresholds

    filled = rows.select(
        "id", "promql", "metric",
        F.coalesce("severity_thresholds", thresholds().cast(schemas.THRESHOLDS)).alias("severity_thresholds"),
        *[F.coalesce(F.col(name), F.lit(value)).cast("int").alias(name)
          for name, value in (("baseline_window_s", 86_400), ("sample_interval_s", 60), ("seasonality_period", 60))],
    )
    complete = F.col("id").isNotNull() & F.col("promql").isNotNull() & F.col("metric").isNotNull()
    return filled.filter(complete), filled.filter(~complete).withColumn("reason", F.lit("missing field"))


#: Columns of a log record and the names a shipper may give them in its JSON.
LOG_FIELDS = {"environment": "environment", "department": "department", "pod": "pod", "host": "host", "given_cluster": "cluster"}


def read_log_topics(records: DataFrame, topic: str = "topic", value: str = "value", log: str = "log",
                    names: Mapping[str, str] = LOG_FIELDS) -> DataFrame:
    """Log records with their metadata fields; the topic stays as ``source_topic``.

    The record is a JSON object with the text in ``log`` and further fields, which ``names``
    maps from the columns they become; other text becomes the log itself.
    """
    meta = T.StructType([T.StructField(n, T.StringType(), True) for n in (log, *names.values())])
    docs = with_parsed(records, F.col(value).cast("string"), meta)
    known = F.col(f"_doc.{log}").isNotNull()
    fields = [F.when(known, F.col(f"_doc.{f}")).alias(name) for name, f in names.items()]
    keep = [c for c in records.columns if c not in (topic, value)]
    return docs.select(
        *keep,
        F.col(topic).alias("source_topic"),
        F.when(known, F.col(f"_doc.{log}")).otherwise(F.col(value).cast("string")).alias("value"),
        *fields,
    )


def header(headers: Column, name: str) -> Column:
    """Value of the first message header of that name."""
    hit = F.filter(headers, lambda h: h["key"] == name)
    return F.get(hit, F.lit(0))["value"].cast("string")


K8S_EVENT = T.StructType([
    T.StructField("type", T.StringType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("message", T.StringType(), True),
    T.StructField("lastTimestamp", T.StringType(), True),
    T.StructField("involvedObject", T.StructType([
        T.StructField("kind", T.StringType(), True),
        T.StructField("namespace", T.StringType(), True),
        T.StructField("name", T.StringType(), True),
    ]), True),
])


def read_k8s_events(records: DataFrame, value: str = "value", headers: str = "headers",
                    cluster_header: str = "cluster") -> DataFrame:
    """Cluster events of both kinds (Warning and Normal); the cluster is a message header."""
    keep = [c for c in records.columns if c not in (value, headers)]
    docs = with_parsed(records, F.col(value).cast("string"), K8S_EVENT)
    return docs.filter(F.col("_doc").isNotNull() & F.col("_doc.type").isin("Warning", "Normal")).select(
        *keep,
        F.col("_doc.type").alias("kind"),
        F.col("_doc.reason").alias("reason"),
        F.col("_doc.message").alias("message"),
        F.try_to_timestamp(F.col("_doc.lastTimestamp")).alias("ts"),
        F.col("_doc.involvedObject.kind").alias("object_kind"),
        F.col("_doc.involvedObject.namespace").alias("namespace"),
        F.col("_doc.involvedObject.name").alias("workload"),
        first_non_empty(header(F.col(headers), cluster_header)).alias("cluster"),
    )


def read_change_webhooks(records: DataFrame, value: str = "value", source: str = "source") -> DataFrame:
    """Webhook bodies with a lower-case source name; bodies of unknown sources are kept too."""
    return records.withColumn(source, F.lower(F.col(source))).withColumn(value, F.col(value).cast("string"))
