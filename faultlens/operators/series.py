"""Metric samples and statistics over time windows.

Rolling statistics run over regularised samples: at most one per interval and
series.  A window then holds a bounded number of rows, and the frames are cut
into time chunks (see ``ordered``), so neither a dense nor a long series ends up
in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from faultlens.functions.columns import SECOND, bucket, from_micros, series_key
from faultlens.operators.ordered import HOUR, framed, halo_chunks, interval_join, previous_within
from faultlens.operators.ranks import WindowRanks

MAD_SCALE = 1.4826
DAY_S = 86_400


def clean_samples(rows: DataFrame, raw: str = "raw") -> DataFrame:
    """Samples of the result rows whose value is a [time, number] pair; NaN is dropped."""
    pair = F.col(raw)
    at = F.get(pair, F.lit(0)).try_cast("double")
    value = F.get(pair, F.lit(1)).try_cast("double")
    out = rows.filter(F.size(pair) == 2).withColumn("_at", at).withColumn("value", value)
    return (
        out.filter(F.col("_at").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value"))
        .withColumn("ts", from_micros(F.round(F.col("_at") * SECOND).cast("long")))
        .drop("_at", raw)
    )


def quarantine_infinite(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Finite samples, and the infinite ones with their dead-letter reason."""
    endless = F.abs("value") == float("inf")
    return samples.filter(~endless), samples.filter(endless).withColumn("reason", F.lit("infinite value"))


def with_series(samples: DataFrame) -> DataFrame:
    return samples.withColumn("series", series_key(F.col("sli_id"), F.col("labels")))


def regularise(samples: DataFrame, keys: Sequence[str], us: str = "us", value: str = "value",
               interval_s: int = 60) -> DataFrame:
    """One sample per series and interval, the last one (the larger value on equal times)."""
    step = interval_s * SECOND
    last = F.max(F.struct(F.col(us), F.col(value)))
    return (
        samples.groupBy(*keys, (bucket(F.col(us), step) * step).alias("slot_us"))
        .agg(last.alias("_last"))
        .select(*keys, "slot_us", F.col(f"_last.{us}").alias("us"), F.col(f"_last.{value}").alias("value"))
    )


def fill_gaps(regular: DataFrame, keys: Sequence[str], interval_s: int = 60) -> DataFrame:
    """Every slot between a series' first and last, ``is_gap`` where no sample exists.

    The grid is laid out day by day, so no row ever holds a whole series' slots.
    """
    step, day = interval_s * SECOND, DAY_S * SECOND
    ends = regular.groupBy(*keys).agg(F.min("slot_us").alias("_lo"), F.max("slot_us").alias("_hi"))
    days = ends.withColumn("_day", F.explode(F.sequence(bucket(F.col("_lo"), day), bucket(F.col("_hi"), day))))
    first = F.greatest(F.col("_lo"), F.ceil(F.col("_day") * day / step).cast("long") * step)
    last = F.least(F.col("_hi"), F.col("_day") * day + (day - 1))
    grid = days.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last").select(
        *keys, F.explode(F.sequence("_first", "_last", F.lit(step).cast("long"))).alias("slot_us"))
    return grid.join(regular, [*keys, "slot_us"], "left").withColumn("is_gap", F.col("us").isNull())


def counter_rate(samples: DataFrame, keys: Sequence[str], us: str, value: str, window_s: int = 300) -> DataFrame:
    """Per-second increase over the window; a drop means the counter restarted at zero."""
    w = window_s * SECOND
    steps = previous_within(samples, keys, us, [], {"_prev": value}, w)
    v, prev = F.col(value), F.col("_prev")
    grown = F.when(prev.isNull(), F.lit(0.0)).when(v < prev, v).otherwise(v - prev)
    out = framed(steps.withColumn("_inc", grown), keys, us, {"_sum": F.sum("_inc")}, w - 1)
    return out.withColumn("rate", F.col("_sum") / F.lit(float(window_s))).drop("_prev", "_inc", "_sum")


def ratio_of_rates(counts: DataFrame, keys: Sequence[str], us: str, part: str, total: str,
                   window_s: int = 300, name: str = "ratio") -> DataFrame:
    """Share of ``part`` in ``total`` over the window, from counts per slot."""
    sums = framed(counts, keys, us, {"_p": F.sum(part), "_t": F.sum(total)}, window_s * SECOND - 1)
    return sums.withColumn(name, F.when(F.col("_t") > 0, F.col("_p") / F.col("_t"))).drop("_p", "_t")


def _over_windows(samples: DataFrame, keys: Sequence[str], us: str, value: str, window_s: int, added: str,
                  compute: Callable[[WindowRanks, np.ndarray, np.ndarray], dict]) -> DataFrame:
    """Columns ``added`` computed from the ranks of the values in each row's window.

    A task gets a chunk of one series and the window before it.  ``compute(ranks, lo, hi)``
    answers for windows that hold a value; other rows get NULL.  NULL and NaN values
    belong to no window.
    """
    w = window_s * SECOND
    out = halo_chunks(samples, us, max(w, HOUR), w)
    fields = StructType.fromDDL(added)
    schema = StructType([*samples.schema.fields, *fields.fields])
    kept, names = samples.columns, fields.names

    def run(group: pa.Table) -> pa.Table:
        at = group.column(us).to_numpy()
        v = group.column(value).cast(pa.float64()).to_numpy()
        held = np.flatnonzero(~np.isnan(v))
        held = held[np.argsort(at[held], kind="stable")]
        own = np.flatnonzero(group.column("_own").to_numpy())
        lo, hi = np.searchsorted(at[held], at[own] - w, "left"), np.searchsorted(at[held], at[own], "right")
        full = hi > lo
        got = {}
        if full.any():
            got = compute(WindowRanks(v[held]), lo[full], hi[full])
        rows = group.take(pa.array(own)).select(kept)
        for name in names:
            column = np.full(len(own), np.nan)
            if name in got:
                column[full] = got[name]
            rows = rows.append_column(name, pa.array(column, from_pandas=True))
        return rows

    return out.groupBy(*keys, "_chunk").applyInArrow(run, schema)


def quantile_over_time(samples: DataFrame, keys: Sequence[str], us: str, value: str, q: float,
                       window_s: int) -> DataFrame:
    """Quantile of the window with linear interpolation, from ranks: the work per row does not grow with the window."""
    return _over_windows(samples, keys, us, value, window_s, "quantile double", lambda r, lo, hi: {"quantile": r.quantile(lo, hi, q)})


def _merged(a: tuple, b: tuple) -> tuple:
    """Count, mean and sum of squared distances from the mean of two sets as one."""
    n = a[0] + b[0]
    step = b[1] - a[1]
    share = b[0] / np.maximum(n, 1)
    return n, a[1] + step * share, a[2] + b[2] + step * (step * share * a[0])


def _moments(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple:
    """Count, mean and sum of squared distances of the values ``lo`` to ``hi``, for many stretches at once.

    A stretch is put together from runs of 1, 2, 4, ... values, one for each bit of its length;
    sums are never subtracted, so a spread keeps its digits beside far larger values.
    """
    at, length = lo.copy(), hi - lo
    found = (np.zeros(len(lo)), np.zeros(len(lo)), np.zeros(len(lo)))
    level, width = (np.ones(len(values)), values, np.zeros(len(values))), 1
    while width <= length.max(initial=0):
        has = np.flatnonzero(length & width)
        joined = _merged(tuple(f[has] for f in found), tuple(x[at[has]] for x in level))
        for f, j in zip(found, joined):
            f[has] = j
        at[has] += width
        level, width = _merged(tuple(x[:-width] for x in level), tuple(x[width:] for x in level)), 2 * width
    return found


def rolling_zscore(samples: DataFrame, keys: Sequence[str], us: str, value: str, window_s: int = 300) -> DataFrame:
    """(x - mean) / stddev over the window; NULL when the window has no spread.

    The work per row grows with the number of digits of the window's row count only.
    """
    w = window_s * SECOND
    out = halo_chunks(samples, us, max(w, HOUR), w)
    schema = StructType([*samples.schema.fields, *StructType.fromDDL("zscore double").fields])
    kept = samples.columns

    def run(group: pa.Table) -> pa.Table:
        at = group.column(us).to_numpy()
        column = group.column(value).cast(pa.float64())
        held = np.flatnonzero(column.is_valid().to_numpy())
        held = held[np.argsort(at[held], kind="stable")]
        v = column.to_numpy()
        own = np.flatnonzero(group.column("_own").to_numpy())
        lo, hi = np.searchsorted(at[held], at[own] - w, "left"), np.searchsorted(at[held], at[own], "right")
        with np.errstate(all="ignore"):  # endless values make a mean or spread NaN
            n, mean, squares = _moments(v[held], lo, hi)
            spread = np.sqrt(squares / np.maximum(n - 1, 1))
            z = (v[own] - mean) / spread
        none = ~column.is_valid().to_numpy()[own] | (n < 2) | (spread <= 1e-9)
        return group.take(pa.array(own)).select(kept).append_column("zscore", pa.array(z, mask=none))

    return out.groupBy(*keys, "_chunk").applyInArrow(run, schema)


def rolling_mad(samples: DataFrame, keys: Sequence[str], us: str, value: str, window_s: int,
                k: float = 3.0) -> DataFrame:
    """Median and median absolute deviation of the window, and the outlier flag.

    Both are selected by rank; the deviations of a window are never laid out.
    """
    def compute(ranks: WindowRanks, lo: np.ndarray, hi: np.ndarray) -> dict:
        n = hi - lo
        median = (ranks.kth(lo, hi, (n - 1) // 2) + ranks.kth(lo, hi, n // 2)) / 2
        return {"median": median, "mad": (ranks.deviation(lo, hi, median, (n - 1) // 2) + ranks.deviation(lo, hi, median, n // 2)) / 2}

    out = _over_windows(samples, keys, us, value, window_s, "median double, mad double", compute)
    far = F.abs(F.col(value) - F.col("median")) > F.lit(k * MAD_SCALE) * F.col("mad")
    return out.withColumn("is_outlier", far)


def burn_rate(counts: DataFrame, keys: Sequence[str], us: str, bad: str, total: str, slo: float,
              short_s: int, long_s: int, factor: float) -> DataFrame:
    """Error-budget burn over a short and a long window; fires when both exceed the factor.

    ``counts`` holds one row per key and slot, so the sums run over few rows.
    """
    out = counts
    for name, window_s in (("short", short_s), ("long", long_s)):
        out = ratio_of_rates(out, keys, us, bad, total, window_s, f"_{name}")
        out = out.withColumn(f"burn_{name}", F.col(f"_{name}") / F.lit(1.0 - slo)).drop(f"_{name}")
    fires = (F.col("burn_short") > factor) & (F.col("burn_long") > factor)
    return out.withColumn("fires", F.coalesce(fires, F.lit(False)))


def sli_summary(incidents: DataFrame, samples: DataFrame, keys: Sequence[str], onset_us: str, us: str, value: str,
                baseline_s: int, observed_s: int) -> DataFrame:
    """p50 and p99 before and after each incident's onset.

    incidents ``(incident_id, keys..., onset)``; samples are regularised, so an
    incident meets at most (baseline + observed) / interval of them.
    """
    right = samples.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col(us).alias("_us"), F.col(value).alias("_value"))
    pairs = interval_join(incidents, right, [(c, f"_{c}") for c in keys], onset_us, "_us",
                          baseline_s * SECOND, observed_s * SECOND, bucket_us=HOUR)
    before = F.col("_us") < F.col(onset_us)

    def pct(cond: Column, q: float, name: str) -> Column:
        return F.percentile(F.when(cond, F.col("_value")), q).alias(name)

    return pairs.groupBy("incident_id").agg(
        pct(before, 0.5, "baseline_p50"), pct(before, 0.99, "baseline_p99"),
        pct(~before, 0.5, "observed_p50"), pct(~before, 0.99, "observed_p99"))


def active_streams(samples: DataFrame, exact: bool = True) -> DataFrame:
    """Number of live series per SLI."""
    count = F.count_distinct("series") if exact else F.approx_count_distinct("series")
    return samples.groupBy("sli_id").agg(count.alias("active_streams"))


def emitted_by_severity(signals: DataFrame) -> DataFrame:
    return signals.groupBy("severity").agg(F.count(F.lit(1)).alias("emitted"))


def collector_counters(answers: DataFrame, samples: DataFrame, scored: DataFrame, hits: DataFrame, emitted: DataFrame,
                       failed: Column | None = None, status: str = "status") -> DataFrame:
    """The collector's counters ``(counter, severity, n)``; severity is set for what was emitted.

    ``answers`` are polls with their status, ``hits`` scored anomalies, ``emitted`` those
    outside the cooldown, ``failed`` tells which of them could not be published.
    """
    failed = F.lit(False) if failed is None else failed

    def rows(df: DataFrame, **counts: Column) -> DataFrame:
        one = df.agg(*[F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, c in counts.items()])
        pairs = F.array(*[F.struct(F.lit(n).alias("counter"), F.lit(None).cast("string").alias("severity"), F.col(n).alias("n")) for n in counts])
        return one.select(F.inline(pairs))

    every = F.count(F.lit(1))
    by_severity = emitted.filter(~failed).groupBy("severity").agg(every.alias("n")).select(F.lit("emitted").alias("counter"), "severity", "n")
    suppressed = rows(hits, all=every).join(rows(emitted, all=every).select("counter", F.col("n").alias("m")), "counter") \
        .select(F.lit("suppressed_cooldown").alias("counter"), "severity", (F.col("n") - F.col("m")).alias("n"))
    parts = [
        rows(answers, polls=every, poll_errors=F.count_if(F.coalesce(F.col(status) != "success", F.lit(True)))),
        rows(samples, samples_received=every, active_streams=F.count_distinct("series")),
        rows(scored, samples_scored=every), by_severity, suppressed, rows(emitted, publish_errors=F.count_if(failed)),
    ]
    return reduce(DataFrame.unionByName, parts)
