"""Shadow runs, calibration, notification and cost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultlens.functions.columns import bucket
from faultlens.operators.ordered import HOUR, numbered
from faultlens.schemas import HYPOTHESIS_SET

# --- fixed values -----------------------------------------------------------
SHADOW_PERCENT = 10
# Lower bound of each confidence band and its meaning.
BANDS = [(0.8, "aligned"), (0.5, "likely"), (0.2, "lead"), (0.0, "needs more data")]
NOTIFY_ABOVE = 0.7
CALLS_PER_INCIDENT = 6
COST_TARGET_USD = 0.15
CONFIRM_PREFIX = "REQUIRES HUMAN CONFIRMATION"
DESTRUCTIVE = r"(?i)\b(delete|drain|destroy)\b"
# -----------------------------------------------------------------------------


def in_shadow(key: Column, percent: int = SHADOW_PERCENT) -> Column:
    """Same answer for the same key, everywhere."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") % 100 < percent


def shadow_sample(rows: DataFrame, key: str = "fingerprint", percent: int = SHADOW_PERCENT) -> DataFrame:
    return rows.filter(in_shadow(F.col(key).cast("string"), percent))


def shadow_metrics(ranked: DataFrame, confirmed: DataFrame, ks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Precision and recall at k of ranked causes against confirmed ones.

    ranked ``(incident_id, cause_id, rank)``, confirmed ``(incident_id, cause_id)``.
    """
    truth = confirmed.select("incident_id", "cause_id").distinct()
    judged = ranked.join(truth.withColumn("_hit", F.lit(1)), ["incident_id", "cause_id"], "left")
    total = truth.agg(F.count(F.lit(1)).alias("confirmed"))
    aggs = []
    for k in ks:
        top = F.col("rank") <= k
        aggs += [F.sum(F.when(top, 1).otherwise(0)).alias(f"_shown{k}"),
                 F.sum(F.when(top & F.col("_hit").isNotNull(), 1).otherwise(0)).alias(f"_hits{k}")]
    # Two single-row frames side by side.
    both = judged.agg(*aggs).withColumn("_one", F.lit(1)).join(total.withColumn("_one", F.lit(1)), "_one")
    rows = F.array(*[F.struct(
        F.lit(k).cast("long").alias("k"), F.col(f"_hits{k}").alias("hits"),
        (F.col(f"_hits{k}") / F.col(f"_shown{k}")).alias("precision"),
        (F.col(f"_hits{k}") / F.col("confirmed")).alias("recall")) for k in ks])
    return both.select(F.inline(rows))


def band(confidence: Column) -> Column:
    name = F.lit(None).cast("string")
    for low, word in sorted(BANDS):
        name = F.when(confidence >= low, word).otherwise(name)
    return name


def calibration_bands(judged: DataFrame) -> DataFrame:
    """Hit rate and mean confidence per band; judged ``(confidence, correct)``."""
    return judged.groupBy(band(F.col("confidence")).alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("correct").cast("double")).alias("hit_rate"),
        F.avg("confidence").alias("mean_confidence"))


def notify_candidates(incidents: DataFrame, notified: DataFrame, on: str = "incident_id") -> DataFrame:
    fresh = incidents.filter(F.col("confidence") > NOTIFY_ABOVE)
    return fresh.join(notified.select(on).distinct(), on, "left_anti")


def validate_hypotheses(answers: DataFrame, known: DataFrame, value: str = "value") -> DataFrame:
    """Problems of each model answer as an array; empty means accepted.

    answers ``(incident_id, value)``, known ``(incident_id, cause)`` lists the causes that
    were in the input.
    """
    docs = answers.select("incident_id", F.explode(F.array(F.from_json(value, HYPOTHESIS_SET))).alias("_d"))
    h = F.col("_d.hypotheses")
    ranks = F.transform(h, lambda x: x["rank"])
    steps = F.flatten(F.transform(h, lambda x: F.coalesce(x["suggested_remediation"], F.array().cast(
        "array<struct<step:string,risk:string,reversible:boolean>>"))))
    rules = {
        "schema": F.col("_d").isNull() | F.col("_d.summary").isNull() | h.isNull(),
        "confidence": F.exists(h, lambda x: x["confidence"].isNull() | ~x["confidence"].between(0.0, 1.0)),
        "rank order": ranks != F.sequence(F.lit(1), F.greatest(F.size(h), F.lit(1))),
        "unconfirmed step": F.exists(steps, lambda s: s["step"].rlike(DESTRUCTIVE) & ~s["step"].startswith(CONFIRM_PREFIX)),
    }
    checked = docs.select("incident_id", "_d", *[F.coalesce(bad, F.lit(False)).alias(f"_{n}") for n, bad in rules.items()])
    cited = checked.select("incident_id", F.explode("_d.hypotheses.cause").alias("cause")).distinct()
    foreign = cited.join(known.select("incident_id", "cause").distinct(), ["incident_id", "cause"], "left_anti") \
        .select("incident_id").distinct().withColumn("_foreign", F.lit(True))
    out = checked.join(foreign, "incident_id", "left")
    names = [F.when(F.col(f"_{n}"), F.lit(n)) for n in rules] + [F.when(F.col("_foreign"), F.lit("unknown cause"))]
    return out.select("incident_id", F.array_compact(F.array(*names)).alias("problems"))


def call_budget(calls: DataFrame, keys: Sequence[str], us: str, tie: Sequence[str], limit: int = CALLS_PER_INCIDENT,
                chunk_us: int = HOUR) -> DataFrame:
    """Number the calls of each incident and mark those beyond the budget."""
    rows = calls.withColumn("_chunk", bucket(F.col(us), chunk_us))
    out = numbered(rows, keys, "_chunk", [us, *tie], "call_no").drop("_chunk")
    return out.withColumn("over_budget", F.col("call_no") > limit)


def cost_rollup(calls: DataFrame) -> DataFrame:
    """Tokens and cost per day and model with subtotals; calls ``(incident_id, model, day, tokens, usd)``."""
    return calls.rollup("day", "model").agg(
        F.sum("tokens").alias("tokens"), F.sum("usd").alias("usd"), F.count(F.lit(1)).alias("calls"))


def costly_incidents(calls: DataFrame, limit: float = COST_TARGET_USD) -> DataFrame:
    per = calls.groupBy("incident_id").agg(F.sum("usd").alias("usd"), F.sum("tokens").alias("tokens"))
    return per.filter(F.col("usd") > limit)


def analysis_status(incidents: DataFrame, analyses: DataFrame, on: str = "incident_id") -> DataFrame:
    """available, pending (asked for, no answer yet) or unavailable; analyses ``(on, answered)``."""
    best = analyses.groupBy(on).agg(F.max("answered").alias("_answered"))
    status = F.when(F.col("_answered"), "available").when(~F.col("_answered"), "pending").otherwise("unavailable")
    return incidents.join(best, on, "left").withColumn("status", status).drop("_answered")
