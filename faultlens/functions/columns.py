"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000  # microseconds

# --- fixed values -----------------------------------------------------------
# Severity words that pass through unchanged, the paging alias and the default.
SEVERITIES = ["info", "warning", "critical"]
PAGING_ALIAS = {"pager": "critical"}
DEFAULT_SEVERITY = "warning"
# Score thresholds used when an SLI states none: (minimum confidence, severity).
DEFAULT_THRESHOLDS = [(0.5, "info"), (0.7, "warning"), (0.9, "critical")]
# Logistic that turns an isolation score into a confidence.
CONFIDENCE_SLOPE = 8.0
CONFIDENCE_CENTRE = 0.55
# -----------------------------------------------------------------------------


def micros(ts: Column) -> Column:
    """Whole microseconds since the epoch; integer time for buckets and frames."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us)


def bucket(us: Column, width_us: int) -> Column:
    """Index of the fixed-width time bucket a microsecond value falls into."""
    return F.floor(us / F.lit(width_us)).cast("long")


def ntz(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def non_empty(c: Column) -> Column:
    return F.when(c != "", c)


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[non_empty(c) for c in cols])


def kv_text(labels: Column) -> Column:
    """Labels as ``k1=v1,k2=v2`` with keys in byte order; an absent map gives ''."""
    pairs = F.transform(
        F.sort_array(F.map_entries(labels)),
        lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))),
    )
    return F.coalesce(F.concat_ws(",", pairs), F.lit(""))


def fingerprint(detector: Column, metric: Column, matchers: Column, cluster: Column) -> Column:
    """First 16 hex digits of the SHA-256 of ``detector|metric|labels|cluster``."""
    text = F.concat_ws("|", detector, metric, kv_text(matchers), cluster)
    return F.substring(F.sha2(text, 256), 1, 16)


def series_key(sli_id: Column, labels: Column) -> Column:
    return F.concat(sli_id, F.lit("|"), kv_text(labels))


def fold_severity(raw: Column) -> Column:
    """Known words in lower case, the paging alias as critical, the rest as warning."""
    word = F.lower(raw)
    folded = F.when(word.isin(SEVERITIES), word)
    for alias, target in PAGING_ALIAS.items():
        folded = folded.when(word == alias, F.lit(target))
    return folded.otherwise(F.lit(DEFAULT_SEVERITY))


def confidence(iso: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(CONFIDENCE_SLOPE) * (iso + CONFIDENCE_CENTRE)))


def thresholds(pairs: list[tuple[float, str]] = DEFAULT_THRESHOLDS) -> Column:
    return F.array(
        *[
            F.struct(F.lit(float(low)).alias("min"), F.lit(word).alias("severity"))
            for low, word in pairs
        ]
    )


def severity_for(conf: Column, limits: Column) -> Column:
    """Severity of the highest threshold the confidence reaches; NULL below all."""
    reached = F.filter(limits, lambda x: x["min"] <= conf)
    return F.get(F.reverse(F.sort_array(reached)), F.lit(0))["severity"]
