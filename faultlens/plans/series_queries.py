"""Samples, rolling statistics and the detector over the events table."""

from pyspark.sql import functions as F

from faultlens.functions.columns import SECOND, confidence, ntz, series_key, severity_for, thresholds
from faultlens.operators import detect as dt
from faultlens.operators import series as ts
from faultlens.operators.ordered import previous_within
from faultlens.operators.forest import fit_isolation_forest, score_isolation_forest
from faultlens.plans import twins
from faultlens.plans.registry import query
from faultlens.session import materialise
from faultlens.sources.records import samples_from_query_results, slis_frame, slis_with_defaults

EVENT_TYPES = ["signup", "error", "click", "view", "purchase"]


def slis(spark):
    """One SLI per event type; errors override window, period and thresholds."""
    items = [{"id": f"sli_{t}", "promql": f"rate({t}[5m])", "metric": f"{t}_total"} for t in EVENT_TYPES]
    items[1] |= {"baseline_window_s": 43_200, "seasonality_period": 24, "severity_thresholds": {0.8: "critical", 0.6: "info"}}
    return slis_frame(spark, items)


def query_answers(spark, sf_dir):
    """Query answers as JSON, one result series each, some of them unusable."""
    ev = twins.events(spark, sf_dir)
    k = F.col("k")
    at = F.concat((F.col("us") / SECOND).cast("long").cast("string"), F.lit("."), F.lpad((F.col("us") % SECOND).cast("string"), 6, "0"))
    number = F.when(k % 10 == 0, "NaN").when(k % 10 == 1, "abc").when(k % 10 == 2, "+Inf").otherwise(F.col("value").cast("string"))
    pair = F.when(k % 10 == 3, F.concat(F.lit("["), at, F.lit("]"))).otherwise(
        F.concat(F.lit("["), at, F.lit(',"'), number, F.lit('"]')))
    labels = F.when(F.col("user_id") % 3 == 0, "").otherwise(F.concat(F.lit('"metric":{"service":"'), F.col("service"), F.lit('","cluster":"'), F.col("cluster"), F.lit('"},')))
    text = F.concat(F.lit('{"status":"'), F.when(k % 17 == 0, "error").otherwise("success"),
                    F.lit('","data":{"resultType":"vector","result":[{'), labels, F.lit('"value":'), pair, F.lit("}]}}"))
    return ev.select(F.concat(F.lit("sli_"), F.col("event_type")).alias("sli_id"), text.alias("value"))


RAW = twins.EVENTS + """,
raw AS (
  SELECT 'sli_' || event_type AS sli_id, event_type || '_total' AS metric, ts, us, k,
    CASE WHEN user_id % 3 = 0 THEN '' ELSE 'cluster=' || cluster || ',service=' || service END AS labels,
    CASE WHEN k % 10 = 2 THEN 'Infinity'::DOUBLE ELSE value END AS value
  FROM ev WHERE k % 17 <> 0
),
smp AS (SELECT * FROM raw WHERE k % 10 NOT IN (0, 1, 3))"""


def spaced_sql(source, gap_us):
    return f"""
nxt AS (SELECT series, us, min(us) OVER (PARTITION BY series ORDER BY us
          RANGE BETWEEN {gap_us} FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM {source}),
kept AS (SELECT series, min(us) AS us FROM {source} GROUP BY 1
         UNION ALL SELECT kept.series, nxt.nx FROM kept JOIN nxt ON kept.series = nxt.series AND kept.us = nxt.us WHERE nxt.nx IS NOT NULL)"""


def samples(spark, sf_dir):
    return ts.clean_samples(samples_from_query_results(query_answers(spark, sf_dir), slis(spark)))


@query("src2_samples_from_query_results", f"WITH {RAW} SELECT sli_id, metric, labels, count(*) AS n FROM raw GROUP BY ALL")
def src2(spark, sf_dir):
    from faultlens.functions.columns import kv_text

    rows = samples_from_query_results(query_answers(spark, sf_dir), slis(spark))
    return rows.groupBy("sli_id", "metric", kv_text(F.col("labels")).alias("labels")).agg(F.count(F.lit(1)).alias("n"))


@query("src3_load_slis", """SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size % 10 <> 0 THEN p_type END AS metric, 3::BIGINT AS n_thresholds,
  CASE WHEN p_size % 2 = 0 THEN p_size * 3600 ELSE 86400 END AS baseline_window_s, 60 AS sample_interval_s, 60 AS seasonality_period,
  CASE WHEN p_size % 10 = 0 THEN 'missing field' END AS reason FROM part""")
def src3(spark, sf_dir):
    part = twins.table(spark, sf_dir, "part")
    rows = part.select(
        F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("rate("), "p_name", F.lit(")")).alias("promql"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_type")).alias("metric"),
        F.lit(None).cast("array<struct<min:double,severity:string>>").alias("severity_thresholds"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size") * 3600).alias("baseline_window_s"),
        F.lit(None).cast("int").alias("sample_interval_s"), F.lit(None).cast("int").alias("seasonality_period"))
    good, bad = slis_with_defaults(rows)
    both = good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)
    return both.select("id", "metric", F.size("severity_thresholds").cast("long").alias("n_thresholds"),
                       "baseline_window_s", "sample_interval_s", "seasonality_period", "reason")


@query("ts1_clean_samples", f"WITH {RAW} SELECT sli_id, ts, value FROM smp")
def ts1(spark, sf_dir):
    return samples(spark, sf_dir).select("sli_id", ntz(F.col("ts")).alias("ts"), "value")


@query("ts2_quarantine_infinite", f"""WITH {RAW}
SELECT CASE WHEN k % 10 = 2 THEN 'infinite value' ELSE 'kept' END AS outcome, count(*) AS n FROM smp GROUP BY 1""")
def ts2(spark, sf_dir):
    good, bad = ts.quarantine_infinite(samples(spark, sf_dir))
    both = good.select(F.lit("kept").alias("outcome")).unionByName(bad.select(F.col("reason").alias("outcome")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("ts3_series_key", f"WITH {RAW} SELECT sli_id || '|' || labels AS series, count(*) AS n FROM smp GROUP BY 1")
def ts3(spark, sf_dir):
    rows = samples(spark, sf_dir)
    return rows.groupBy(series_key(F.col("sli_id"), F.col("labels")).alias("series")).agg(F.count(F.lit(1)).alias("n"))


def regular(spark, sf_dir, interval_s=60):
    ev = twins.events(spark, sf_dir).select(F.col("event_type").alias("series"), "us", "value")
    return ts.regularise(ev, ["series"], interval_s=interval_s)


def regular_sql(interval_s=60):
    step = interval_s * SECOND
    return twins.EVENTS + f""",
reg AS (SELECT event_type AS series, us // {step} * {step} AS slot_us, max(us) AS us, arg_max(value, us) AS value FROM ev GROUP BY 1, 2)"""


REG = regular_sql()
# All events; whole cents add up exactly in any order, so an hour's mean is the same number everywhere.
EVERY = twins.EVENTS + ", every AS (SELECT event_type AS series, event_id, us, value FROM ev)"
REG_HOUR = twins.EVENTS + """,
reg AS (SELECT event_type AS series, us // 3600000000 * 3600000000 AS slot_us,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100.0::DOUBLE AS value FROM ev GROUP BY 1, 2)"""


def every_event(spark, sf_dir):
    return twins.events(spark, sf_dir).select(F.col("event_type").alias("series"), "event_id", "us", "value")


def hourly_means(spark, sf_dir):
    slot = (F.floor(F.col("us") / (3600 * SECOND)) * (3600 * SECOND)).alias("slot_us")
    cents = F.sum(F.round(F.col("value") * 100).cast("long")).cast("double")
    return every_event(spark, sf_dir).groupBy("series", slot).agg((cents / F.count(F.lit(1)) / 100.0).alias("value"))


@query("ts4_regularise", f"WITH {REG} SELECT series, slot_us, us, value FROM reg")
def ts4(spark, sf_dir):
    return regular(spark, sf_dir).select("series", "slot_us", "us", "value")


@query("ts4_fill_gaps", f"""WITH {REG}
SELECT series, CAST((max(slot_us) - min(slot_us)) // 60000000 + 1 AS BIGINT) AS n_slots,
  CAST((max(slot_us) - min(slot_us)) // 60000000 + 1 - count(*) AS BIGINT) AS n_gaps FROM reg GROUP BY 1""")
def ts4b(spark, sf_dir):
    full = ts.fill_gaps(regular(spark, sf_dir), ["series"])
    return full.groupBy("series").agg(F.count(F.lit(1)).alias("n_slots"), F.sum(F.col("is_gap").cast("long")).alias("n_gaps"))


@query("ts5_counter_rate", f"""WITH {twins.EVENTS},
reg AS (SELECT event_type AS series, us // 60000000 * 60000000 AS slot_us, arg_max(k, us)::DOUBLE AS value FROM ev GROUP BY 1, 2),
prv AS (SELECT *, CASE WHEN slot_us - lag(slot_us) OVER w < 3600000000 THEN lag(value) OVER w END AS prev FROM reg
        WINDOW w AS (PARTITION BY series ORDER BY slot_us)),
inc AS (SELECT *, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS inc FROM prv)
SELECT series, slot_us, round(sum(inc) OVER (PARTITION BY series ORDER BY slot_us
  RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) / 3600.0::DOUBLE, 6) AS rate FROM inc""")
def ts5(spark, sf_dir):
    ev = twins.events(spark, sf_dir).select(F.col("event_type").alias("series"), "us", F.col("k").cast("double").alias("value"))
    rows = ts.counter_rate(ts.regularise(ev, ["series"]), ["series"], "slot_us", "value", 3600)
    return rows.select("series", "slot_us", F.round("rate", 6).alias("rate"))


@query("ts6_quantile_over_time", f"""WITH {EVERY}
SELECT series, event_id, round(quantile_cont(value, 0.9) OVER (PARTITION BY series ORDER BY us
  RANGE BETWEEN 21600000000 PRECEDING AND CURRENT ROW), 4) AS quantile FROM every""")
def ts6(spark, sf_dir):
    rows = ts.quantile_over_time(every_event(spark, sf_dir), ["series"], "us", "value", 0.9, 21_600)
    return rows.select("series", "event_id", F.round("quantile", 4).alias("quantile"))


@query("ts7_rolling_zscore", f"""WITH {EVERY},
z AS (SELECT series, event_id, value, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s FROM every
  WINDOW w AS (PARTITION BY series ORDER BY us RANGE BETWEEN 21600000000 PRECEDING AND CURRENT ROW))
SELECT series, event_id, round(CASE WHEN s > 1e-9 THEN (value - m) / s END, 6) AS zscore FROM z""")
def ts7(spark, sf_dir):
    rows = ts.rolling_zscore(every_event(spark, sf_dir), ["series"], "us", "value", 21_600)
    return rows.select("series", "event_id", F.round("zscore", 6).alias("zscore"))


@query("ts8_rolling_mad", f"""WITH {EVERY},
m AS (SELECT series, event_id, value, median(value) OVER w AS med, mad(value) OVER w AS mad FROM every
  WINDOW w AS (PARTITION BY series ORDER BY us RANGE BETWEEN 21600000000 PRECEDING AND CURRENT ROW))
SELECT series, event_id, round(med, 4) AS median, round(mad, 4) AS mad, abs(value - med) > 4.4478::DOUBLE * mad AS is_outlier FROM m""")
def ts8(spark, sf_dir):
    rows = ts.rolling_mad(every_event(spark, sf_dir), ["series"], "us", "value", 21_600)
    return rows.select("series", "event_id", F.round("median", 4).alias("median"), F.round("mad", 4).alias("mad"), "is_outlier")


@query("ts9_burn_rate", f"""WITH {twins.EVENTS},
c AS (SELECT service, us // 60000000 * 60000000 AS slot_us, count(*) FILTER (event_type = 'error') AS bad, count(*) AS total
      FROM ev GROUP BY 1, 2),
b AS (SELECT service, slot_us,
  sum(bad) OVER s::DOUBLE / sum(total) OVER s / (1.0::DOUBLE - 0.9::DOUBLE) AS short,
  sum(bad) OVER l::DOUBLE / sum(total) OVER l / (1.0::DOUBLE - 0.9::DOUBLE) AS long FROM c
  WINDOW s AS (PARTITION BY service ORDER BY slot_us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW),
         l AS (PARTITION BY service ORDER BY slot_us RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW))
SELECT service, slot_us, round(short, 6) AS burn_short, round(long, 6) AS burn_long, short > 3 AND long > 3 AS fires FROM b""")
def ts9(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    slot = (F.floor(F.col("us") / (60 * SECOND)) * (60 * SECOND)).alias("slot_us")
    counts = ev.groupBy("service", slot).agg(
        F.sum((F.col("event_type") == "error").cast("long")).alias("bad"), F.count(F.lit(1)).alias("total"))
    rows = ts.burn_rate(counts, ["service"], "slot_us", "bad", "total", 0.9, 3600, 21_600, 3.0)
    return rows.select("service", "slot_us", F.round("burn_short", 6).alias("burn_short"),
                       F.round("burn_long", 6).alias("burn_long"), "fires")


@query("ts10_sli_summary", f"""WITH {twins.EVENTS},
inc AS (SELECT service || '-' || (us // 86400000000) AS incident_id, service, min(us) AS onset FROM ev
        WHERE event_type = 'error' GROUP BY 1, 2),
j AS (SELECT incident_id, value, us < onset AS before FROM inc JOIN ev USING (service)
      WHERE us BETWEEN onset - 21600000000 AND onset + 7200000000)
SELECT incident_id, round(quantile_cont(value, 0.5) FILTER (before), 4) AS baseline_p50,
  round(quantile_cont(value, 0.99) FILTER (before), 4) AS baseline_p99,
  round(quantile_cont(value, 0.5) FILTER (NOT before), 4) AS observed_p50,
  round(quantile_cont(value, 0.99) FILTER (NOT before), 4) AS observed_p99 FROM j GROUP BY 1""")
def ts10(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    day = F.floor(F.col("us") / (86_400 * SECOND)).cast("string")
    incidents = ev.filter("event_type = 'error'").groupBy(
        F.concat("service", F.lit("-"), day).alias("incident_id"), "service").agg(F.min("us").alias("onset"))
    rows = ts.sli_summary(incidents, ev, ["service"], "onset", "us", "value", 21_600, 7200)
    return rows.select("incident_id", *[F.round(c, 4).alias(c) for c in rows.columns if c != "incident_id"])


@query("ts11_active_streams", f"""WITH {RAW}
SELECT sli_id, count(DISTINCT sli_id || '|' || labels) AS active_streams FROM smp GROUP BY 1""")
def ts11(spark, sf_dir):
    return ts.active_streams(ts.with_series(samples(spark, sf_dir)))


@query("ts12_emitted_by_severity", f"""WITH {twins.EVENTS},
j AS (SELECT CASE WHEN value / 200 >= 0.9 THEN 'critical' WHEN value / 200 >= 0.7 THEN 'warning' WHEN value / 200 >= 0.5 THEN 'info' END AS severity FROM ev)
SELECT severity, count(*) AS emitted FROM j WHERE severity IS NOT NULL GROUP BY 1""")
def ts12(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    judged = ev.withColumn("severity", severity_for(F.col("value") / 200, thresholds()))
    return ts.emitted_by_severity(judged.filter("severity IS NOT NULL"))


@query("ts12_collector_counters", f"""WITH RECURSIVE {RAW},
reg AS (SELECT event_type AS series, us // 60000000 * 60000000 AS slot_us, max(us) AS us, arg_max(value, us) AS value FROM ev GROUP BY 1, 2),
cnt AS (SELECT series, us, value, count(*) OVER (PARTITION BY series ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS n_history FROM reg),
warm AS (SELECT * FROM cnt WHERE n_history >= 60),
hit AS (SELECT series, us, value, CASE WHEN value > 120 THEN 'critical' ELSE 'info' END AS severity FROM warm WHERE value > 40),
{spaced_sql('hit', 300_000_000)},
sent AS (SELECT hit.* FROM hit JOIN kept ON hit.series = kept.series AND hit.us = kept.us)
SELECT 'polls' AS counter, NULL::VARCHAR AS severity, count(*) AS n FROM ev
UNION ALL SELECT 'poll_errors', NULL, count(*) FILTER (k % 17 = 0) FROM ev
UNION ALL SELECT 'samples_received', NULL, count(*) FROM smp
UNION ALL SELECT 'active_streams', NULL, count(DISTINCT sli_id || '|' || labels) FROM smp
UNION ALL SELECT 'samples_scored', NULL, count(*) FROM warm
UNION ALL SELECT 'emitted', severity, count(*) FROM sent WHERE value <= 150 GROUP BY severity
UNION ALL SELECT 'suppressed_cooldown', NULL, (SELECT count(*) FROM hit) - (SELECT count(*) FROM sent)
UNION ALL SELECT 'publish_errors', NULL, count(*) FILTER (value > 150) FROM sent""")
def ts12b(spark, sf_dir):
    """All eight counters; what is a hit, and what fails to be published, is read off the values."""
    answers = query_answers(spark, sf_dir).select(F.get_json_object("value", "$.status").alias("status"))
    warm = dt.warm_gate(regular(spark, sf_dir), ["series"], min_samples=60)
    hits = materialise(warm.filter("value > 40").withColumn("severity", F.when(F.col("value") > 120, "critical").otherwise("info")), "hits")
    sent = materialise(dt.cooldown(hits, ["series"]), "sent")
    return ts.collector_counters(answers, ts.with_series(samples(spark, sf_dir)), warm, hits, sent, F.col("value") > 150)


@query("jn8_sli_enrich", f"""WITH {twins.EVENTS}
SELECT 'sli_' || event_type AS sli_id, event_type || '_total' AS metric,
  CASE WHEN event_type = 'error' THEN 43200 ELSE 86400 END AS baseline_window_s, count(*) AS n FROM ev GROUP BY ALL""")
def jn8(spark, sf_dir):
    from faultlens.operators.joins import sli_enrich

    ev = twins.events(spark, sf_dir).select(F.concat(F.lit("sli_"), F.col("event_type")).alias("sli_id"), "value")
    return sli_enrich(ev, slis(spark)).groupBy("sli_id", "metric", "baseline_window_s").agg(F.count(F.lit(1)).alias("n"))


@query("dt1_history", f"""WITH {REG}
SELECT series, us, count(*) OVER w AS n_history, avg(round(value * 100)) OVER w AS mean_history FROM reg
WINDOW w AS (PARTITION BY series ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW)""")
def dt1(spark, sf_dir):
    # Whole cents add up exactly in any order.
    rows = regular(spark, sf_dir).withColumn("value", F.round(F.col("value") * 100))
    return dt.history(rows, ["series"]).select("series", "us", "n_history", "mean_history")


WARM = REG + """,
cnt AS (SELECT series, us, value, count(*) OVER (PARTITION BY series ORDER BY us
          RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS n_history FROM reg),
warm AS (SELECT series, us, value, n_history FROM cnt WHERE n_history >= 60)"""


@query("dt2_warm_gate", f"WITH {WARM} SELECT series, us, n_history FROM warm")
def dt2(spark, sf_dir):
    return dt.warm_gate(regular(spark, sf_dir), ["series"], min_samples=60).select("series", "us", "n_history")


@query("dt3_refit_schedule", f"WITH RECURSIVE {WARM}, {spaced_sql('warm', 3_600_000_000)} SELECT series, us FROM kept")
def dt3(spark, sf_dir):
    warm = dt.warm_gate(regular(spark, sf_dir), ["series"], min_samples=60)
    return dt.refit_schedule(warm, ["series"]).select("series", "us")


OWN = """own AS (SELECT series, us, value, CASE WHEN series = 'error' THEN 43200000000 ELSE 86400000000 END AS w FROM reg)"""


@query("dt14_own_windows", f"""WITH RECURSIVE {REG}, {OWN},
cnt AS (SELECT series, us, count(*) OVER (PARTITION BY series ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS n FROM own WHERE w = 86400000000
        UNION ALL SELECT series, us, count(*) OVER (PARTITION BY series ORDER BY us RANGE BETWEEN 43200000000 PRECEDING AND CURRENT ROW) FROM own WHERE w = 43200000000),
warm AS (SELECT series, us, n FROM cnt WHERE n >= 30), {spaced_sql('warm', 3_600_000_000)}
SELECT kept.series, kept.us, n AS n_history FROM kept JOIN warm ON kept.series = warm.series AND kept.us = warm.us""")
def dt14b(spark, sf_dir):
    """Refit times of the batch detector, each SLI by its own window; samples are polled once a minute, as the detector does."""
    own = slis(spark).select(F.regexp_replace("id", "sli_", "").alias("series"), "baseline_window_s")
    warm = dt.warm_gate(regular(spark, sf_dir).join(own, "series"), ["series"], "us", "baseline_window_s", 30)
    return dt.refit_schedule(warm, ["series"]).join(warm, ["series", "us"]).select("series", "us", "n_history")


@query("dt14_detect_own_settings")
def dt14c(spark, sf_dir):
    """Anomalies of events polled once a minute, errors with a window, a period and limits of their own."""
    ev = twins.events(spark, sf_dir).withColumn("series", F.col("event_type"))
    own = slis(spark).withColumn("series", F.regexp_replace("id", "sli_", ""))
    return dt.detect(ts.regularise(ev, ["series"]), ["series"], min_samples=60, trees=50, settings=own)


DECOMPOSED = REG_HOUR + """,
blk AS (SELECT *, slot_us // 864000000000 AS block, (slot_us // 3600000000) % 24 AS phase FROM reg),
trd AS (SELECT *, avg(value) OVER (PARTITION BY series, block ORDER BY slot_us ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) AS trend FROM blk),
ssn AS (SELECT *, quantile_cont(value - trend, 0.5) OVER (PARTITION BY series, block, phase) AS seasonal FROM trd),
dec AS (SELECT *, value - trend - seasonal AS residual FROM ssn)"""


def decomposed(spark, sf_dir):
    rows = hourly_means(spark, sf_dir)
    return dt.seasonal_decompose(rows, ["series"], period=24, interval_s=3600, block_us=10 * dt.DAY_US)


@query("dt4_seasonal_decompose", f"""WITH {DECOMPOSED}
SELECT series, slot_us, phase, round(trend, 8) AS trend, round(seasonal, 8) AS seasonal, round(residual, 8) AS residual FROM dec""")
def dt4(spark, sf_dir):
    return decomposed(spark, sf_dir).select(
        "series", "slot_us", "phase", *[F.round(c, 8).alias(c) for c in ("trend", "seasonal", "residual")])


@query("dt4_block_baseline", f"""WITH {DECOMPOSED},
a AS (SELECT *, count(*) OVER (PARTITION BY series, block) AS n, row_number() OVER (PARTITION BY series, block ORDER BY slot_us DESC) AS age,
        quantile_cont(value, 0.5) OVER (PARTITION BY series, block) AS med FROM dec),
r AS (SELECT *, CASE WHEN n >= 48 THEN residual ELSE value - med END AS res FROM a)
SELECT series, block, count(*) AS n,
  round(CASE WHEN min(n) >= 48 THEN avg(trend + seasonal) FILTER (age <= 24) ELSE min(med) END, 4) AS baseline_mean,
  round(CASE WHEN stddev_pop(res) > 0 THEN stddev_pop(res) ELSE 1.0 END, 4) AS baseline_std FROM r GROUP BY 1, 2""")
def dt4b(spark, sf_dir):
    rows = dt.block_baseline(decomposed(spark, sf_dir), ["series"], period=24)
    return rows.select("series", "block", "n", F.round("baseline_mean", 4).alias("baseline_mean"), F.round("baseline_std", 4).alias("baseline_std"))


@query("dt5_median_baseline", f"""WITH {REG}
SELECT series, slot_us // 86400000000 AS block, round(quantile_cont(value, 0.5), 4) AS baseline_mean FROM reg GROUP BY 1, 2""")
def dt5(spark, sf_dir):
    return dt.median_baseline(regular(spark, sf_dir), ["series"]).select("series", "block", F.round("baseline_mean", 4).alias("baseline_mean"))


@query("dt6_residual_std", f"""WITH {DECOMPOSED}
SELECT series, block, round(CASE WHEN stddev_pop(residual) > 0 THEN stddev_pop(residual) ELSE 1.0 END, 4) AS residual_std FROM dec GROUP BY 1, 2""")
def dt6(spark, sf_dir):
    rows = dt.residual_std(decomposed(spark, sf_dir), ["series", "block"])
    return rows.select("series", "block", F.round("residual_std", 4).alias("residual_std"))


@query("dt7_fit_isolation_forest", f"""WITH {twins.EVENTS}
SELECT event_type, 100 AS n_trees, CAST(least(256, count(*)) AS INTEGER) AS psi, 100 AS n_roots FROM ev GROUP BY 1""")
def dt7(spark, sf_dir):
    """What is determined of the forests: trees, points a tree has seen at most, and roots that no node points to."""
    models = fit_isolation_forest(twins.events(spark, sf_dir), ["event_type"], F.array("value"), ["event_id"])
    inner = F.size(F.filter("child", lambda c: c >= 0))
    return models.select("event_type", "n_trees", "psi", (F.size("path") - 2 * inner).alias("n_roots"))


@query("dt8_score_isolation_forest", f"""WITH {twins.EVENTS}
SELECT event_type, count(*) AS n, count(*) AS n_in_range, true AS far_stands_out FROM ev GROUP BY 1""")
def dt8(spark, sf_dir):
    """All points are scored within range, and a planted outlier of each group (id -1) is far below their mean."""
    ev = twins.events(spark, sf_dir).select("event_id", "event_type", "value")
    models = fit_isolation_forest(ev, ["event_type"], F.array("value"), ["event_id"])
    far = ev.groupBy("event_type").agg((F.max("value") * 1000).alias("value")).select(F.lit(-1).cast("long").alias("event_id"), "event_type", "value")
    scored = score_isolation_forest(ev.unionByName(far), models, ["event_type"], F.array("value"))
    real = F.col("event_id") >= 0
    return scored.groupBy("event_type").agg(
        F.count_if(real).alias("n"), F.count_if(real & F.col("iso_score").between(-1.0, -1e-9)).alias("n_in_range"),
        (F.min(F.when(~real, F.col("iso_score"))) < F.avg("iso_score") - 0.1).alias("far_stands_out"))


@query("dt8_detect_series")
def dt8b(spark, sf_dir):
    """Each kind of event polled once a minute, as the detector does, over six days of history."""
    ev = twins.events(spark, sf_dir).withColumn("series", F.col("event_type"))
    return dt.detect(ts.regularise(ev, ["series"]), ["series"], window_s=6 * 86_400)


@query("dt8_detect_facts", f"""WITH RECURSIVE {WARM}, {spaced_sql('warm', 3_600_000_000)}
SELECT w.series, n_scored, n_fits, true AS in_range, true AS follows_limits, true AS spaced FROM (SELECT series, count(*) AS n_scored FROM warm GROUP BY 1) w
JOIN (SELECT series, count(*) AS n_fits FROM kept GROUP BY 1) k ON k.series = w.series""")
def dt8c(spark, sf_dir):
    """What is determined of a detector run on samples polled once a minute: scored samples, fits, ranges, limits, and emissions five minutes apart."""
    rows = materialise(regular(spark, sf_dir), "regular")
    warm = materialise(dt.warm_gate(rows, ["series"], min_samples=60), "warm")
    fits = materialise(dt.refit_schedule(warm, ["series"]), "fits")
    scored = materialise(dt.judge(dt.score_series(rows, ["series"], fits, min_samples=60, trees=20)), "scored")
    hits = dt.cooldown(scored.filter("severity IS NOT NULL"), ["series"])
    reached = F.when(F.col("confidence") >= 0.9, "critical").when(F.col("confidence") >= 0.7, "warning").when(F.col("confidence") >= 0.5, "info")
    facts = scored.groupBy("series").agg(
        F.count(F.lit(1)).alias("n_scored"), F.bool_and(F.col("iso_score").between(-1.0, -1e-9) & F.col("confidence").between(0.0, 1.0)).alias("in_range"),
        F.bool_and(F.col("severity").eqNullSafe(reached)).alias("follows_limits"))
    gaps = previous_within(hits, ["series"], "us", [], {"before": "us"}, 300 * SECOND).groupBy("series").agg(F.bool_and(F.col("before").isNull()).alias("spaced"))
    return facts.join(fits.groupBy("series").agg(F.count(F.lit(1)).alias("n_fits")), "series").join(gaps, "series", "left").select(
        "series", "n_scored", "n_fits", "in_range", "follows_limits", F.coalesce("spaced", F.lit(True)).alias("spaced"))


@query("dt9_confidence", f"""WITH {twins.EVENTS}
SELECT event_id, round(1 / (1 + exp(8.0::DOUBLE * (-value / 300 + 0.55::DOUBLE))), 6) AS confidence FROM ev""")
def dt9(spark, sf_dir):
    return twins.events(spark, sf_dir).select("event_id", F.round(confidence(-F.col("value") / 300), 6).alias("confidence"))


@query("dt10_severity_for", f"""WITH {twins.EVENTS},
c AS (SELECT event_id, round(value / 200, 2) AS conf FROM ev)
SELECT event_id, CASE WHEN conf >= 0.9::DOUBLE THEN 'critical' WHEN conf >= 0.7::DOUBLE THEN 'warning' WHEN conf >= 0.5::DOUBLE THEN 'info' END AS severity FROM c""")
def dt10(spark, sf_dir):
    conf = F.round(F.col("value") / 200, 2)
    return twins.events(spark, sf_dir).select("event_id", severity_for(conf, thresholds()).alias("severity"))


@query("dt11_cooldown", f"""WITH RECURSIVE {REG},
hit AS (SELECT series, us, value FROM reg WHERE value > 40),
{spaced_sql('hit', 300_000_000)}
SELECT hit.series, hit.us, value FROM hit JOIN kept ON hit.series = kept.series AND hit.us = kept.us""")
def dt11(spark, sf_dir):
    hits = regular(spark, sf_dir).filter("value > 40")
    return dt.cooldown(hits, ["series"]).select("series", "us", "value")


@query("dt12_samples_to_signals", f"""WITH {RAW}, s AS (
  SELECT *, CASE WHEN labels = '' THEN 'home' ELSE split_part(split_part(labels, ',', 1), '=', 2) END AS cluster FROM smp WHERE k % 10 <> 2)
SELECT 'ml:isoforest:' || sli_id AS detector, 2 AS tier, ts AS ts_started, cluster,
  CASE WHEN labels <> '' THEN split_part(labels, 'service=', 2) END AS service,
  substr(sha256('ml:isoforest:' || sli_id || '|' || metric || '|' || labels || '|' || cluster), 1, 16) AS fingerprint,
  round(value / 700, 4) AS confidence, round(value / 3, 6) AS baseline_mean, value AS observed, 0.0::DOUBLE AS duration_s,
  'rate(' || replace(metric, '_total', '') || '[5m])' AS promql, ts - INTERVAL 5 MINUTE AS window_start, ts AS window_end FROM s""")
def dt12(spark, sf_dir):
    good, _ = ts.quarantine_infinite(samples(spark, sf_dir))
    hits = good.select(
        "*", F.lit("info").alias("severity"), (F.col("value") / 700).alias("confidence"), (F.col("value") / 3).alias("baseline_mean"),
        F.lit(1.0).alias("baseline_std"), F.lit(-0.6).alias("iso_score"), F.lit(0.5).alias("residual"))
    e = F.col("evidence")
    return dt.samples_to_signals(hits, "home", F.lit("2024-02-01").cast("timestamp")).select(
        "detector", "tier", ntz(F.col("ts_started")).alias("ts_started"), "cluster", "service", "fingerprint", "confidence",
        F.col("values.baseline_mean").alias("baseline_mean"), F.col("values.observed").alias("observed"),
        F.col("values.duration_s").alias("duration_s"), e["promql"].alias("promql"),
        ntz(e["window"]["start"]).alias("window_start"), ntz(e["window"]["end"]).alias("window_end"))


@query("dt13_multivariate_detect", f"""WITH {twins.EVENTS},
p AS (SELECT cluster, us // 3600000000 * 3600000000 AS slot_us FROM ev WHERE event_type IN ('error', 'view') GROUP BY 1, 2 HAVING count(DISTINCT event_type) = 2)
SELECT cluster, slot_us, true AS in_range FROM p""")
def dt13(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    slot = (F.floor(F.col("us") / (3600 * SECOND)) * (3600 * SECOND)).alias("slot_us")
    points = dt.multivariate_points(ev.select(slot, "cluster", "event_type", "value"), "event_type", ["error", "view"], keys=["cluster"])
    models = fit_isolation_forest(points, ["cluster"], F.col("vector"), ["slot_us"])
    return score_isolation_forest(points, models, ["cluster"], F.col("vector")).select("cluster", "slot_us", F.col("iso_score").between(-1.0, -1e-9).alias("in_range"))


@query("dt14_per_sli_overrides", f"""WITH {twins.EVENTS},
c AS (SELECT event_id, event_type, round(value / 200, 2) AS conf FROM ev)
SELECT event_id, CASE WHEN event_type = 'error' THEN 24 ELSE 60 END AS seasonality_period,
  CASE WHEN event_type = 'error' THEN CASE WHEN conf >= 0.8::DOUBLE THEN 'critical' WHEN conf >= 0.6::DOUBLE THEN 'info' END
       WHEN conf >= 0.9::DOUBLE THEN 'critical' WHEN conf >= 0.7::DOUBLE THEN 'warning' WHEN conf >= 0.5::DOUBLE THEN 'info' END AS severity
FROM c""")
def dt14(spark, sf_dir):
    ev = twins.events(spark, sf_dir).select("event_id", F.concat(F.lit("sli_"), F.col("event_type")).alias("sli_id"), "value")
    rows = dt.with_overrides(ev, slis(spark))
    return rows.select("event_id", "seasonality_period",
                       severity_for(F.round(F.col("value") / 200, 2), F.col("severity_thresholds")).alias("severity"))


