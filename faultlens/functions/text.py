"""Patterns and text expressions for log lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# What counts as personal data in a log line.  Long digit runs are told apart by
# their exact length; masking runs in this order.
PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<EMAIL>"),
    "pan": (r"[A-Z]{5}[0-9]{4}[A-Z]", "<PAN>"),
    "aadhaar": (r"(?<![0-9+])[0-9]{12}(?![0-9])", "<AADHAAR>"),
    "phone": (r"(?<![0-9])(?:\+91[- ]?)?[0-9]{10}(?![0-9])", "<PHONE>"),
    "cvv": (r"((?i:cvv2?)[^0-9*]{0,10})[0-9]{3,4}", "$1***"),
}
# Variable parts of a line, masked in this order when it is tokenised.
HOLE = "<*>"
VARIABLES = [
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(:[0-9]+)?",
    r"0x[0-9a-fA-F]+",
    r"[0-9]+(\.[0-9]+)?",
]
BLANKS = r"[ \t\r\n\f]+"
# -----------------------------------------------------------------------------


def mask(text: Column, kind: str) -> Column:
    pattern, token = PII[kind]
    return F.regexp_replace(text, pattern, token)


def mask_all(text: Column) -> Column:
    for kind in PII:
        text = mask(text, kind)
    return text


def pii_hits(text: Column, kind: str) -> Column:
    return F.regexp_count(text, F.lit(PII[kind][0]))


def may_hold_pii(text: Column) -> Column:
    """False for texts in which no kind can be found: each needs an @ or three digits side by side."""
    return text.contains("@") | text.rlike("[0-9]{3}")


def tokenise(line: Column) -> Column:
    """Tokens of a line with its variable parts replaced by holes."""
    for pattern in VARIABLES:
        line = F.regexp_replace(line, pattern, HOLE)
    return raw_tokens(line)


def raw_tokens(line: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(line, BLANKS, " ")), " ")


CLUSTER_NAME = r"^(?:([a-z]+)-)?([a-z]+)-cluster-([0-9]+)$"


def decode_cluster(name: Column, datacentres: Mapping[str, str], pattern: str = CLUSTER_NAME) -> Column:
    """Data centre, role and number encoded in a cluster name.

    ``datacentres`` maps prefixes to names; the pattern's groups are prefix, role and number.
    """
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))

    centre = F.create_map(*[F.lit(x) for pair in datacentres.items() for x in pair])[part(1)] if datacentres else F.lit(None).cast("string")
    return F.struct(centre.alias("datacentre"), part(2).alias("role"), part(3).cast("int").alias("number"))
