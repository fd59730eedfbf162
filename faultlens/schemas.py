"""Struct types of the records that cross a job boundary."""

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# Times inside an alert stay text so that one unreadable time spoils only its own alert.
ALERT = _struct(
    status=T.StringType(),
    labels=STRING_MAP,
    annotations=STRING_MAP,
    startsAt=T.StringType(),
    endsAt=T.StringType(),
    generatorURL=T.StringType(),
    fingerprint=T.StringType(),
)

ALERT_PAYLOAD = _struct(
    version=T.StringType(),
    groupKey=T.StringType(),
    status=T.StringType(),
    receiver=T.StringType(),
    groupLabels=STRING_MAP,
    commonLabels=STRING_MAP,
    commonAnnotations=STRING_MAP,
    externalURL=T.StringType(),
    alerts=T.ArrayType(ALERT),
)

# One instant-query answer: value is a two-element [time, text] array.
QUERY_RESULT = _struct(
    status=T.StringType(),
    data=_struct(
        result=T.ArrayType(_struct(metric=STRING_MAP, value=T.ArrayType(T.StringType())))
    ),
)

THRESHOLDS = T.ArrayType(_struct(min=T.DoubleType(), severity=T.StringType()))

SLI = _struct(
    id=T.StringType(),
    promql=T.StringType(),
    metric=T.StringType(),
    severity_thresholds=THRESHOLDS,
    baseline_window_s=T.IntegerType(),
    sample_interval_s=T.IntegerType(),
    seasonality_period=T.IntegerType(),
)

SAMPLE = _struct(
    sli_id=T.StringType(),
    metric=T.StringType(),
    promql=T.StringType(),
    labels=STRING_MAP,
    ts=T.TimestampType(),
    value=T.DoubleType(),
)

# Keys written into a signal's `values`; tier 1 fills two of them, tier 2 all.
SIGNAL_VALUES = _struct(
    observed=T.DoubleType(),
    baseline_mean=T.DoubleType(),
    baseline_std=T.DoubleType(),
    iso_score=T.DoubleType(),
    residual=T.DoubleType(),
    duration_s=T.DoubleType(),
)

CHANGE_EVENT = _struct(
    event_id=T.StringType(),
    event_type=T.StringType(),
    source=T.StringType(),
    ts=T.TimestampType(),
    actor=T.StringType(),
    target=_struct(
        kind=T.StringType(),
        namespace=T.StringType(),
        name=T.StringType(),
        cluster=T.StringType(),
    ),
    git=_struct(repo=T.StringType(), sha=T.StringType(), pr=T.IntegerType()),
    diff_ref=T.StringType(),
    raw_payload_ref=T.StringType(),
)

HYPOTHESIS_SET = _struct(
    summary=T.StringType(),
    hypotheses=T.ArrayType(
        _struct(
            rank=T.IntegerType(),
            cause=T.StringType(),
            confidence=T.DoubleType(),
            evidence=T.ArrayType(T.StringType()),
            contradicting_evidence=T.ArrayType(T.StringType()),
            suggested_remediation=T.ArrayType(
                _struct(step=T.StringType(), risk=T.StringType(), reversible=T.BooleanType())
            ),
        )
    ),
    needs_more_data=T.ArrayType(T.StringType()),
)
