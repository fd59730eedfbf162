"""The metric detector: history, seasonal baseline, forest score, severity, cooldown.

Batch jobs work on regularised samples in day-long blocks with a halo of one
baseline window.  Everything up to the score is exact; the one difference from the
stateful stream (``streaming.detector``) is that samples suppressed by a cooldown
stay in the history here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlens.functions.columns import (
    SECOND, bucket, confidence, fingerprint, first_non_empty, severity_for, thresholds,
)
from faultlens.operators.alerts import EVIDENCE_LEAD, SCHEMA_VERSION, hoisted_service
from faultlens.operators.forest import SEED, TREES, grow, isolation_score
from faultlens.operators.joins import join_dimension, sli_enrich
from faultlens.operators.ordered import asof_join, framed, halo_chunks, interval_join, spaced
from faultlens.session import materialise, python_tasks

# --- fixed values -----------------------------------------------------------
BASELINE_WINDOW_S = 86_400
PERIOD = 60
REFIT_EVERY_S = 3600
COOLDOWN_S = 300
MIN_SAMPLES = 120
ML_DETECTOR_PREFIX = "ml:isoforest:"
# -----------------------------------------------------------------------------
DAY_US = 86_400 * SECOND


def history(samples: DataFrame, keys: Sequence[str], us: str = "us", value: str = "value",
            window_s: int = BASELINE_WINDOW_S) -> DataFrame:
    """Number and mean of the samples in the window; a sample exactly at its edge counts."""
    return framed(samples, keys, us, {"n_history": F.count(F.lit(1)), "mean_history": F.avg(value)}, window_s * SECOND)


def _own_history(samples: DataFrame, keys: Sequence[str], us: str, window: str, name: str) -> DataFrame:
    """Add the number of samples in the window before each, whose length in seconds is a column of the key."""
    most = (samples.agg(F.max(window)).first()[0] or 0) * SECOND
    out = halo_chunks(samples, us, max(most, DAY_US), most)
    columns = samples.columns

    def count(group: pa.Table) -> pa.Table:
        at = np.sort(group.column(us).to_numpy())
        rows = group.filter(group.column("_own"))
        here = rows.column(us).to_numpy()
        since = here - rows.column(window).to_numpy().astype(np.int64) * SECOND
        n = np.searchsorted(at, here, "right") - np.searchsorted(at, since, "left")
        return rows.select(columns).append_column(name, pa.array(n))

    return out.groupBy(*keys, "_chunk").applyInArrow(count, samples.withColumn(name, F.lit(0).cast("long")).schema)


def warm_gate(samples: DataFrame, keys: Sequence[str], us: str = "us", window_s: int | str = BASELINE_WINDOW_S,
              min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Samples that have enough history to be scored, themselves included.

    ``window_s`` may name a column that holds each key's own window.
    """
    if isinstance(window_s, str):
        counted = _own_history(samples, keys, us, window_s, "n_history")
    else:
        counted = framed(samples, keys, us, {"n_history": F.count(F.lit(1))}, window_s * SECOND)
    return counted.filter(F.col("n_history") >= min_samples)


def refit_schedule(warm: DataFrame, keys: Sequence[str], us: str = "us", every_s: int = REFIT_EVERY_S) -> DataFrame:
    """Times at which the model is rebuilt: first warm sample, then every hour or later."""
    return spaced(warm, keys, us, every_s * SECOND)


def cooldown(hits: DataFrame, keys: Sequence[str], us: str = "us", gap_s: int = COOLDOWN_S) -> DataFrame:
    """Hits that are emitted; those less than ``gap_s`` after an emitted one are suppressed."""
    return hits.join(spaced(hits, keys, us, gap_s * SECOND), [*keys, us], "left_semi")


def _blocks(samples: DataFrame, us: str, block_us: int) -> DataFrame:
    return samples.withColumn("block", bucket(F.col(us), block_us))


def seasonal_decompose(samples: DataFrame, keys: Sequence[str], slot_us: str = "slot_us", value: str = "value",
                       period: int = PERIOD, interval_s: int = 60, block_us: int = DAY_US) -> DataFrame:
    """Trend, seasonal part and residual inside each block (training window) of a series.

    Trend is a centred moving average over one period; the seasonal part is the
    median deviation from it at the same phase.  Nothing crosses a block.
    """
    by = [*keys, "block"]
    around = W.partitionBy(*by).orderBy(slot_us).rowsBetween(-(period // 2), period // 2)
    out = _blocks(samples, slot_us, block_us).withColumn("trend", F.avg(value).over(around))
    phase = F.pmod(F.floor(F.col(slot_us) / (interval_s * SECOND)), F.lit(period)).cast("long")
    out = out.withColumn("phase", phase).withColumn("_off", F.col(value) - F.col("trend"))
    at_phase = W.partitionBy(*by, "phase")
    return (
        out.withColumn("seasonal", F.percentile("_off", 0.5).over(at_phase))
        .withColumn("residual", F.col("_off") - F.col("seasonal"))
        .drop("_off")
    )


def block_baseline(decomposed: DataFrame, keys: Sequence[str], slot_us: str = "slot_us", value: str = "value",
                   period: int = PERIOD) -> DataFrame:
    """Per block: baseline mean and residual spread, from the decomposition when the
    block holds two periods or more, else from the median.

    The baseline mean is the mean of trend plus seasonal part over the last period.
    """
    by = [*keys, "block"]
    newest = W.partitionBy(*by).orderBy(F.desc(slot_us))
    whole = W.partitionBy(*by)
    rows = (
        decomposed.withColumn("_n", F.count(F.lit(1)).over(whole))
        .withColumn("_age", F.row_number().over(newest))
        .withColumn("_median", F.percentile(value, 0.5).over(whole))
    )
    seasonal = F.col("_n") >= 2 * period
    residual = F.when(seasonal, F.col("residual")).otherwise(F.col(value) - F.col("_median"))
    recent = F.when(F.col("_age") <= period, F.col("trend") + F.col("seasonal"))
    spread = F.stddev_pop(residual)
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.when(F.first("_n") >= 2 * period, F.avg(recent)).otherwise(F.first("_median")).alias("baseline_mean"),
        F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias("baseline_std"),
    )


def median_baseline(samples: DataFrame, keys: Sequence[str], slot_us: str = "slot_us", value: str = "value",
                    block_us: int = DAY_US) -> DataFrame:
    """Median of each block."""
    middle = F.percentile(value, 0.5).alias("baseline_mean")
    return _blocks(samples, slot_us, block_us).groupBy(*keys, "block").agg(middle)


def residual_std(rows: DataFrame, keys: Sequence[str], residual: str = "residual") -> DataFrame:
    """Population deviation of the residuals without NaN; 0 becomes 1."""
    kept = F.when(~F.isnan(residual), F.col(residual))
    spread = F.stddev_pop(kept)
    return rows.groupBy(*keys).agg(F.when(spread > 0, spread).otherwise(F.lit(1.0)).alias("residual_std"))


RESIDUAL_MODES = ("baseline_mean", "pointwise")


@dataclass
class Fit:
    """Forest, baseline mean and residual spread of a training window, and the baseline over its last period."""

    forest: dict
    mean: float
    spread: float
    last: np.ndarray

    def baseline(self, since: int | np.ndarray, mode: str = RESIDUAL_MODES[0]) -> float | np.ndarray:
        """What a sample ``since`` places after the window's end is held against: the mean, or the baseline at its own phase."""
        return self.mean if mode == "baseline_mean" else self.last[(np.asarray(since) - 1) % len(self.last)]


def centred_residuals(values: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """The same decomposition for one training window held in numpy; residuals, and the baseline over the last period."""
    n = len(values)
    if n < 2 * period:
        middle = float(np.median(values))
        return values - middle, np.array([middle])
    half = period // 2
    total = np.concatenate([[0.0], np.cumsum(values)])
    lo = np.maximum(np.arange(n) - half, 0)
    hi = np.minimum(np.arange(n) + half + 1, n)
    trend = (total[hi] - total[lo]) / (hi - lo)
    off = values - trend
    seasonal = np.empty(n)
    for phase in range(period):
        seasonal[phase::period] = np.median(off[phase::period])
    return off - seasonal, (trend + seasonal)[-period:]


def fit_window(values: np.ndarray, period: int = PERIOD, trees: int = TREES, seed: int = SEED) -> Fit:
    residuals, last = centred_residuals(values, period)
    finite = np.isfinite(residuals)
    spread = residuals.std(where=finite)
    return Fit(grow(residuals[finite, None], trees, seed=seed), float(last.mean()), float(spread if spread > 0 else 1.0), last)


SAMPLE, FIT, TRAIN = 0, 1, 2  #: what a shipped row is
SCORED = "us long, value double, iso_score double, baseline_mean double, baseline_std double, residual double"


def score_series(samples: DataFrame, keys: Sequence[str], fits: DataFrame, us: str = "us", value: str = "value",
                 window_s: int | str = BASELINE_WINDOW_S, period: int | str = PERIOD, min_samples: int = MIN_SAMPLES,
                 trees: int = TREES, residual_mode: str = RESIDUAL_MODES[0]) -> DataFrame:
    """Scores of all warm samples against the model in force at their time.

    ``fits(keys, us)`` are the refit times; ``window_s`` and ``period`` may name columns
    that hold each key's own.  A task receives one block of one series, the window before
    it, and the training window of the model in force when the block begins, however old
    that is: a bounded number of regularised samples, each shipped about three times.
    Models live and die inside the task.
    """
    own = {"_w": window_s, "_p": period}
    own = {n: F.col(c) if isinstance(c, str) else F.lit(c) for n, c in own.items()}
    longest = samples.agg(F.max(window_s)).first()[0] or 1 if isinstance(window_s, str) else window_s
    block_us = longest * SECOND
    none = F.lit(None).cast("long")
    data = samples.select(*keys, F.col(us).alias("us"), F.col(value).alias("value"), F.lit(SAMPLE).alias("what"), none.alias("fit_at"),
                          *[c.cast("long").alias(n) for n, c in own.items()])
    marks = fits.select(*keys, F.col(us).alias("us"), F.lit(None).cast("double").alias("value"), F.lit(FIT).alias("what"), none.alias("fit_at"),
                        *[none.alias(n) for n in own])
    near = halo_chunks(data.unionByName(marks), "us", block_us, block_us)
    starts = data.select(*keys, F.floor(F.col("us") / block_us).alias("_chunk")).distinct().withColumn("_begin", F.col("_chunk") * block_us)
    in_force = asof_join(starts, marks.select(*keys, "us", F.col("us").alias("fit_at_")), keys, "_begin", "us", ["fit_at_"]).filter("fit_at_ IS NOT NULL")
    past = data.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.col("us").alias("_r_us"), F.col("value").alias("_r_value"), *own)
    train = interval_join(in_force, past, [(k, f"_r_{k}") for k in keys], "fit_at_", "_r_us", block_us, 0).select(
        *keys, F.col("_r_us").alias("us"), F.col("_r_value").alias("value"), F.lit(TRAIN).alias("what"), F.col("fit_at_").alias("fit_at"),
        *own, "_chunk", F.lit(False).alias("_own"))
    both = near.unionByName(train)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("us")
        rows, old = pdf[pdf["what"] == SAMPLE], pdf[pdf["what"] == TRAIN]
        none = pdf[list(keys)].iloc[:0].assign(**{c: np.array([], dtype=t) for c, t in SCORED_DTYPES.items()})
        if not len(rows):
            return none
        window, phases = int(rows["_w"].iloc[0]) * SECOND, int(rows["_p"].iloc[0])
        begin = int(pdf["_chunk"].iloc[0]) * block_us
        fit_at = pdf.loc[(pdf["what"] == FIT) & (pdf["us"] > begin), "us"].to_numpy()
        if len(old):  # the model in force at the block's start; a fit at that very time is it
            fit_at = np.concatenate([[int(old["fit_at"].iloc[0])], fit_at])
            old = old[old["us"] >= fit_at[0] - window]
        at, values = rows["us"].to_numpy(), rows["value"].to_numpy(dtype=float)
        history_size = np.arange(1, len(at) + 1) - np.searchsorted(at, at - window, side="left")
        model_no = np.searchsorted(fit_at, at, side="right") - 1
        wanted = rows["_own"].to_numpy() & (history_size >= min_samples) & (model_no >= 0)
        out = []
        for no in np.unique(model_no[wanted]):
            moment = fit_at[no]
            if len(old) and no == 0:
                train = old["value"].to_numpy(dtype=float)
            else:
                train = values[np.searchsorted(at, moment - window, side="left"):np.searchsorted(at, moment, side="right")]
            fit = fit_window(train, phases, trees)
            mine = wanted & (model_no == no)
            since = np.flatnonzero(mine) - (np.searchsorted(at, moment, side="right") - 1)
            residual = values[mine] - fit.baseline(since, residual_mode)
            out.append(pd.DataFrame({
                "us": at[mine], "value": values[mine],
                "iso_score": isolation_score(fit.forest, residual.reshape(-1, 1)),
                "baseline_mean": fit.mean, "baseline_std": fit.spread, "residual": residual,
            }))
        if not out:
            return none
        scored = pd.concat(out, ignore_index=True)
        for k in reversed(keys):
            scored.insert(0, k, pdf[k].iloc[0])
        return scored

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in samples.select(*keys).schema.fields)
    # Few rows, much work per row: keep the tasks apart instead of merging small partitions.
    both = both.repartition(python_tasks(samples.sparkSession), *keys, "_chunk")
    return both.groupBy(*keys, "_chunk").applyInPandas(score, f"{fields}, {SCORED}")


SCORED_DTYPES = {f.split()[0]: {"long": "int64", "double": "float64"}[f.split()[1]] for f in SCORED.split(", ")}


def judge(scored: DataFrame, limits: Column | None = None) -> DataFrame:
    """Confidence and severity of the scores; severity is NULL for normal samples."""
    limits = thresholds() if limits is None else limits
    out = scored.withColumn("confidence", confidence(F.col("iso_score")))
    return out.withColumn("severity", severity_for(F.col("confidence"), limits))


def with_overrides(samples: DataFrame, slis: DataFrame) -> DataFrame:
    """Attach each SLI's own thresholds, window and period (defaults fill the rest)."""
    return sli_enrich(samples, slis)


def detect(samples: DataFrame, keys: Sequence[str] = ("series",), us: str = "us", value: str = "value",
           window_s: int = BASELINE_WINDOW_S, period: int = PERIOD, min_samples: int = MIN_SAMPLES,
           refit_every_s: int = REFIT_EVERY_S, cooldown_s: int = COOLDOWN_S, trees: int = TREES,
           settings: DataFrame | None = None, residual_mode: str = RESIDUAL_MODES[0]) -> DataFrame:
    """Emitted anomalies of regularised samples.

    ``settings(keys, baseline_window_s, seasonality_period, severity_thresholds)`` are what
    keys set themselves; parts that are NULL and keys without a row take the defaults.
    """
    if settings is not None:
        own = settings.select(*keys, "baseline_window_s", "seasonality_period")
        samples = materialise(join_dimension(samples, own, keys).withColumns({
            "_window_s": F.coalesce("baseline_window_s", F.lit(window_s)).cast("int"),
            "_period": F.coalesce("seasonality_period", F.lit(period)).cast("int")}), "samples")
        window_s, period = "_window_s", "_period"
    warm = warm_gate(samples, keys, us, window_s, min_samples)
    fits = refit_schedule(warm.select(*keys, us), keys, us, refit_every_s)
    scored = score_series(samples, keys, fits, us, value, window_s, period, min_samples, trees, residual_mode)
    if settings is None:
        judged = judge(scored)
    else:
        limits = join_dimension(scored, settings.select(*keys, "severity_thresholds"), keys)
        judged = judge(limits, F.coalesce("severity_thresholds", thresholds())).drop("severity_thresholds")
    hits = materialise(judged.filter("severity IS NOT NULL"), "hits")
    return cooldown(hits, keys, "us", cooldown_s)


def samples_to_signals(hits: DataFrame, default_cluster: str, as_of: Column | None = None) -> DataFrame:
    """Tier-2 signals of emitted samples.

    hits ``(sli_id, metric, promql, labels, ts, value, iso_score, baseline_mean,
    baseline_std, residual, confidence, severity)``.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    labels = F.col("labels")
    cluster = F.coalesce(first_non_empty(labels["cluster"]), F.lit(default_cluster))
    detector = F.concat(F.lit(ML_DETECTOR_PREFIX), F.col("sli_id"))
    window = F.struct((F.col("ts") - F.expr(f"INTERVAL {EVIDENCE_LEAD}")).alias("start"), F.col("ts").alias("end"))
    values = F.struct(
        F.col("value").alias("observed"),
        *[F.round(c, 6).alias(c) for c in ("baseline_mean", "baseline_std", "iso_score", "residual")],
        F.lit(0.0).alias("duration_s"),
    )
    return hits.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(2).alias("tier"),
        detector.alias("detector"),
        as_of.alias("ts_detected"),
        F.col("ts").alias("ts_started"),
        F.lit(None).cast("timestamp").alias("ts_resolved"),
        fingerprint(detector, F.col("metric"), labels, cluster).alias("fingerprint"),
        F.struct(F.col("metric").alias("name"), labels.alias("matchers")).alias("metric"),
        cluster.alias("cluster"),
        labels["namespace"].alias("namespace"),
        hoisted_service(labels, present_wins=False).alias("service"),
        "severity",
        F.round("confidence", 4).alias("confidence"),
        values.alias("values"),
        F.struct(
            F.col("promql").alias("promql"), window.alias("window"),
            F.lit(None).cast("array<struct<ts:timestamp,value:double>>").alias("samples"),
        ).alias("evidence"),
        labels.alias("source_labels"),
        F.create_map().cast("map<string,string>").alias("annotations"),
    )


def multivariate_points(samples: DataFrame, metric: str, metrics: Sequence[str], slot_us: str = "slot_us",
                        value: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """One vector per slot with the mean of each metric; slots lacking one are left out."""
    wide = samples.groupBy(*keys, slot_us).pivot(metric, list(metrics)).agg(F.avg(value))
    complete = wide.dropna(subset=list(metrics))
    return complete.select(*keys, slot_us, F.array(*[F.col(f"`{m}`") for m in metrics]).alias("vector"))


