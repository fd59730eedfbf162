"""Raw log records to masked, normalised log rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultlens.functions.columns import first_non_empty, fold_severity
from faultlens.functions.text import PII, mask_all, may_hold_pii, pii_hits

# --- fixed values -----------------------------------------------------------
# Topic pattern -> format of the records on it; the first match counts.
FORMATS = [
    ("^linkerd-proxy-", "logfmt"),
    ("^haproxy-|^ingress-", "haproxy"),
    ("^java-", "stacktrace"),
    (".", "json"),
]
LOGFMT_PAIR = r'([A-Za-z_][A-Za-z0-9_.]*)=("(?:[^"\\]|\\.)*"|[^ "]*)'
HAPROXY_LINE = (
    r"^([0-9a-fA-F.:]+):([0-9]+) \[([^\]]+)\] (\S+) ([^/ ]+)/(\S+) "
    r"(-?[0-9]+)/(-?[0-9]+)/(-?[0-9]+)/(-?[0-9]+)/(\+?[0-9]+) (-?[0-9]+) (\+?[0-9]+) "
    r'.*"(\S+) (\S+)(?: [^"]*)?"$'
)
HAPROXY_FIELDS = ["client_ip", "client_port", "accepted", "frontend", "backend", "server",
                  "t_request", "t_queue", "t_connect", "t_response", "t_total", "status", "bytes", "method", "path"]
STACK_HEAD = r'^(?:Exception in thread "[^"]*" |Caused by: )?([A-Za-z_][A-Za-z0-9_.$]*(?:Exception|Error))\b'
# -----------------------------------------------------------------------------

LABELS = "map<string,string>"


def _last_wins(entries: Column) -> Column:
    """Map of the entries; a repeated key keeps its last value."""
    return F.aggregate(
        entries, F.create_map().cast(LABELS),
        lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, v: k != e["key"]), F.create_map(e["key"], e["value"])))


def parse_logfmt(text: Column) -> Column:
    """Labels of a ``key=value`` line, quotes removed; NULL if it has no pair."""
    keys = F.regexp_extract_all(text, F.lit(LOGFMT_PAIR), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(LOGFMT_PAIR), F.lit(2))
    entries = F.zip_with(keys, values, lambda k, v: F.struct(
        k.alias("key"),
        F.when(v.startswith('"'), F.replace(F.substring(v, F.lit(2), F.length(v) - 2), F.lit('\\"'), F.lit('"'))).otherwise(v).alias("value")))
    return F.when(F.size(keys) > 0, _last_wins(entries))


def parse_haproxy(text: Column) -> Column:
    """Labels of an HTTP access line; NULL if the line does not have its form."""
    fields = [x for i, name in enumerate(HAPROXY_FIELDS)
              for x in (F.lit(name), F.regexp_extract(text, HAPROXY_LINE, i + 1))]
    return F.when(text.rlike(HAPROXY_LINE), F.create_map(*fields))


def parse_json(text: Column) -> Column:
    """Top-level fields of a JSON object as text; NULL for anything else."""
    opened = F.ltrim(text).startswith("{")
    return F.when(opened & F.try_parse_json(text).isNotNull(), F.from_json(text, LABELS))


def parse_stacktrace(text: Column) -> Column:
    """Exception class and number of frames; the text itself stays in one piece."""
    name = F.regexp_extract(text, STACK_HEAD, 1)
    frames = F.regexp_count(text, F.lit(r"\n[ \t]*at "))
    return F.when(name != "", F.create_map(F.lit("exception"), name, F.lit("frames"), frames.cast("string")))


PARSERS = {"logfmt": parse_logfmt, "haproxy": parse_haproxy, "json": parse_json, "stacktrace": parse_stacktrace}


def log_format(topic: Column, formats: Sequence[tuple[str, str]] = FORMATS) -> Column:
    chosen = F.lit(None).cast("string")
    for pattern, name in reversed(list(formats)):
        chosen = F.when(topic.rlike(pattern), name).otherwise(chosen)
    return chosen


def department_filter(logs: DataFrame, departments: Sequence[str], department: str = "department") -> DataFrame:
    return logs.filter(F.col(department).isin(list(departments)))


def dispatch_parse(logs: DataFrame, topic: str = "source_topic", value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Rows with ``format`` and ``fields``, and the unparsable rows for the dead letters.

    The generator holds the parse result, so the split reads it instead of parsing again.
    """
    kind = log_format(F.col(topic))
    fields = F.lit(None).cast(LABELS)
    for name, parser in PARSERS.items():
        fields = F.when(kind == name, parser(F.col(value))).otherwise(fields)
    rows = logs.withColumn("format", kind).select("*", F.explode(F.array(fields)).alias("fields"))
    good = rows.filter(F.col("fields").isNotNull())
    bad = rows.filter(F.col("fields").isNull()).drop("fields").withColumn("reason", F.lit("unparsable"))
    return good, bad


def normalise_log(parsed: DataFrame, cluster: str = "cluster", pod: str = "pod") -> DataFrame:
    """The ten fields of a parsed log; message and label values are masked.

    ``cluster`` and ``pod`` name the columns the shipper put these in.
    """
    f = F.col("fields")

    def field(*names: str) -> Column:
        return first_non_empty(*[f[n] for n in names])

    message = F.when(F.col("format").isin("haproxy", "stacktrace"), F.col("value")).otherwise(
        F.coalesce(field("message", "msg", "log"), F.col("value")))
    level = F.when(F.col("format") == "stacktrace", "critical").otherwise(F.coalesce(field("severity", "level"), F.lit("info")))
    level = F.when(F.lower(level).isin("error", "fatal"), "critical").otherwise(level)
    taken = ["timestamp", "ts", "time", "namespace", "pod", "container", "service", "severity", "level", "message", "msg", "log"]
    labels = F.transform_values(F.map_filter(f, lambda k, v: ~k.isin(taken)), lambda k, v: mask_all(v))
    return parsed.select(
        *[c for c in parsed.columns if c.startswith("_")],
        F.try_to_timestamp(field("timestamp", "ts", "time")).alias("timestamp"),
        F.col(cluster).alias("cluster"),
        field("namespace").alias("namespace"),
        F.coalesce(field("pod"), F.col(pod)).alias("pod"),
        field("container").alias("container"),
        F.coalesce(field("service"), F.regexp_extract("source_topic", r"([^-]+)$", 1)).alias("service"),
        fold_severity(level).alias("severity"),
        mask_all(message).alias("message"),
        labels.alias("labels"),
        "source_topic",
    )


def pii_audit(texts: DataFrame, text: str) -> DataFrame:
    """Maskable hits per kind, before and after masking."""
    whole = F.col(text)

    def hits(column: Column, kind: str) -> Column:  # 0 for most texts, whose letters are looked at once
        found = F.when(F.col("_maybe"), pii_hits(column, kind)).when(whole.isNotNull(), F.lit(0))
        return F.sum(found.cast("long"))

    counts = [F.struct(F.lit(kind).alias("kind"), hits(whole, kind).alias("hits"), hits(F.col("_masked"), kind).alias("left")) for kind in PII]
    looked = texts.select(text, F.explode(F.array(may_hold_pii(whole))).alias("_maybe"))
    masked = looked.select(text, "_maybe", F.explode(F.array(F.when(F.col("_maybe"), mask_all(whole)).otherwise(whole))).alias("_masked"))
    return masked.agg(F.array(*counts).alias("_c")).select(F.inline("_c"))
