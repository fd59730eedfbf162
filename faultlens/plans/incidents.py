"""Correlation, ranking, incident and topology queries."""

from pyspark.sql import functions as F

from faultlens.functions.columns import SECOND, from_micros, micros, ntz
from faultlens.operators import correlate as cr
from faultlens.operators import joins as jn
from faultlens.operators import retrieve, templates
from faultlens.operators import topology as gr
from faultlens.operators.series import sli_summary
from faultlens.plans import twins
from faultlens.plans.log_queries import TEMPLATES, lines
from faultlens.plans.registry import query
from faultlens.plans.retrieval_queries import KNN
from faultlens.plans.twins import EVENTS, INCIDENT_PARTS
from faultlens.session import materialise, run_dir
from faultlens.sources.sinks import expire, upsert_incidents


@query("cr6_rank_causes", f"""WITH {INCIDENT_PARTS}
SELECT anomaly_id, cluster, service, "rank", cand_id, kind, cause_service, score FROM ranked""")
def cr6(spark, sf_dir):
    ranked = twins.ranked_causes(twins.events(spark, sf_dir))
    return ranked.select("anomaly_id", "cluster", "service", "rank", "cand_id", "kind", "cause_service", "score")


def user_pairs(spark, sf_dir):
    """Anomalies with the candidates of the same user in their window."""
    ev = twins.events(spark, sf_dir)
    who = ev.select(F.col("event_id").alias("_id"), "user_id")
    left = twins.anomalies(ev).join(who, F.col("anomaly_id") == F.col("_id")).drop("_id")
    right = twins.candidates(ev).join(who, F.col("cand_id") == F.col("_id")).select(
        F.col("user_id").alias("cand_user"), "cand_id", "kind", F.col("service").alias("cause_service"), "c_us")
    # A wide window, so that a single user's few events meet.
    return cr.pull_window(left, right, [("user_id", "cand_user")], 24 * 3600 * SECOND, 5 * 60 * SECOND)


USER_PAIRS = INCIDENT_PARTS + """,
up AS (SELECT a.*, c.cand_id, c.kind, c.service AS cause_service, c.c_us FROM anom a JOIN cand c ON a.user_id = c.user_id
   AND c.c_us BETWEEN a.a_us - 86400000000 AND a.a_us + 300000000)"""


@query("jn1_interval_join", f"WITH {USER_PAIRS} SELECT anomaly_id, cand_id, kind, c_us - a_us AS gap_us FROM up")
def jn1(spark, sf_dir):
    return user_pairs(spark, sf_dir).select("anomaly_id", "cand_id", "kind", (F.col("c_us") - F.col("a_us")).alias("gap_us"))


@query("cr1_f_time", f"WITH {USER_PAIRS} SELECT anomaly_id, cand_id, round(exp(-abs(c_us - a_us) / 600000000.0::DOUBLE), 9) AS f_time FROM up")
def cr1(spark, sf_dir):
    gap = F.col("c_us") - F.col("a_us")
    return user_pairs(spark, sf_dir).select("anomaly_id", "cand_id", F.round(cr.f_time(gap), 9).alias("f_time"))


@query("cr2_f_topo", f"""WITH {INCIDENT_PARTS}
SELECT service, cause_service, round(greatest(1.0::DOUBLE / (1.0::DOUBLE + down), 0.5::DOUBLE / (1.0::DOUBLE + up)), 6) AS f_topo FROM dist""")
def cr2(spark, sf_dir):
    d = twins.distances(twins.events(spark, sf_dir))
    return d.select("service", "cause_service", F.round(cr.f_topo(F.col("down"), F.col("up")), 6).alias("f_topo"))


@query("cr3_f_hist", f"""WITH {INCIDENT_PARTS} SELECT signature, kind, round((ok + 1.0::DOUBLE) / (n + 2.0::DOUBLE), 9) AS f_hist FROM hist""")
def cr3(spark, sf_dir):
    h = cr.history(twins.feedback(twins.events(spark, sf_dir)))
    return h.select("signature", "kind", F.round(cr.f_hist(F.col("ok"), F.col("n")), 9).alias("f_hist"))


@query("cr4_f_kind", """SELECT o_orderstatus AS status, CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'O' THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END AS f_kind,
  count(*) AS n FROM orders GROUP BY 1, 2""")
def cr4(spark, sf_dir):
    kind = F.when(F.col("o_orderstatus") == "F", "deploy").when(F.col("o_orderstatus") == "O", "tf_apply").otherwise("other")
    rows = twins.table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), cr.f_kind(kind).alias("f_kind"))
    return rows.groupBy("status", "f_kind").agg(F.count(F.lit(1)).alias("n"))


def scored_pairs(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    rows = jn.join_dimension(user_pairs(spark, sf_dir), cr.history(twins.feedback(ev)), ["signature", "kind"])
    # Causes of the same user are on the anomaly's own service.
    return rows.withColumn("score", F.round(cr.score(
        cr.f_time(F.col("c_us") - F.col("a_us")), cr.f_topo(F.lit(0), F.lit(0)), cr.f_hist(F.col("ok"), F.col("n")),
        cr.f_kind(F.col("kind"))), 9))


SCORED_PAIRS = USER_PAIRS + """,
sp AS (SELECT up.*, round(0.4::DOUBLE * exp(-abs(c_us - a_us) / 600000000.0::DOUBLE) + 0.3::DOUBLE
   + 0.2::DOUBLE * (coalesce(ok, 0) + 1.0::DOUBLE) / (coalesce(n, 0) + 2.0::DOUBLE)
   + 0.1::DOUBLE * CASE WHEN up.kind = 'deploy' THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END, 9) AS score
  FROM up LEFT JOIN hist ON up.signature = hist.signature AND up.kind = hist.kind)"""


@query("cr5_score", f"WITH {SCORED_PAIRS} SELECT anomaly_id, cand_id, score FROM sp")
def cr5(spark, sf_dir):
    return scored_pairs(spark, sf_dir).select("anomaly_id", "cand_id", "score")


@query("ag4_top_n_causes", f"""WITH {SCORED_PAIRS},
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY anomaly_id ORDER BY score DESC, cand_id) AS INTEGER) AS "rank" FROM sp)
SELECT anomaly_id, cand_id, "rank" FROM r WHERE "rank" <= 5""")
def ag4(spark, sf_dir):
    return cr.top_causes(scored_pairs(spark, sf_dir), ["anomaly_id"], [F.desc("score"), F.asc("cand_id")]).select(
        "anomaly_id", "cand_id", "rank")


@query("cr7_cause_summary", f"""WITH {USER_PAIRS},
g AS (SELECT *, abs(c_us - a_us) // 1000000 AS s FROM up)
SELECT anomaly_id, cand_id, kind || ' of ' || cause_service || ' at ' || strftime(make_timestamp(c_us), '%H:%M:%S') || ' (T'
  || CASE WHEN c_us > a_us THEN '+' ELSE '-' END || CASE WHEN s >= 600 THEN (s // 60) || 'm' ELSE s || 's' END || ')' AS summary FROM g""")
def cr7(spark, sf_dir):
    text = cr.cause_summary(F.col("kind"), F.col("cause_service"), from_micros(F.col("c_us")), F.col("c_us") - F.col("a_us"))
    return user_pairs(spark, sf_dir).select("anomaly_id", "cand_id", text.alias("summary"))


@query("cr8_build_incidents", f"""WITH {INCIDENT_PARTS}
SELECT anomaly_id, CAST(count(*) AS BIGINT) AS n_causes, string_agg(CAST(cand_id AS VARCHAR), ',' ORDER BY "rank") AS causes FROM ranked GROUP BY 1""")
def cr8(spark, sf_dir):
    rows = cr.build_incidents(twins.ranked_causes(twins.events(spark, sf_dir)))
    causes = F.col("ranked_candidate_causes")
    return rows.select("anomaly_id", F.size(causes).cast("long").alias("n_causes"),
                       F.array_join(F.transform(causes, lambda c: c["change_event_id"].cast("string")), ",").alias("causes"))


BEFORE_S, AFTER_S = 6 * 3600, 2 * 3600  #: what counts as before an onset and after it

SHIFTS = TEMPLATES + f""",
slot AS (SELECT replace(service, 'src', 'svc') AS service, template, epoch_us(ts) // 60000000 * 60000000 AS slot_us FROM tp),
onset AS (SELECT event_id AS anomaly_id, 'svc' || (user_id % 10) AS service, epoch_us(ts) // 60000000 * 60000000 AS edge FROM events WHERE event_type = 'error'),
cnt AS (SELECT anomaly_id, o.service, template, count(*) FILTER (slot_us < edge) AS count_before, count(*) FILTER (slot_us >= edge) AS count_after
        FROM onset o JOIN slot ON o.service = slot.service AND slot_us >= edge - {BEFORE_S}000000 AND slot_us < edge + {AFTER_S}000000 GROUP BY ALL),
shift AS (SELECT *, count_before = 0 AS is_new, (count_after + 1.0::DOUBLE) / (count_before + 1.0::DOUBLE) AS ratio FROM cnt),
sharp AS (SELECT * FROM shift WHERE is_new OR ratio >= 2 OR ratio <= 0.5)"""


def service_logs(spark, sf_dir):
    return lines(spark, sf_dir).withColumn("service", F.regexp_replace("service", "src", "svc"))


def onset_shifts(spark, sf_dir, carried=None, onto=None):
    ev = twins.events(spark, sf_dir).filter("event_type = 'error'")
    asked = ev.select(F.col("event_id").alias("incident"), "service", F.col("us").alias("onset_us"))
    return templates.onset_shifts(service_logs(spark, sf_dir), asked, BEFORE_S, AFTER_S, carried=carried, onto=onto)


@query("cr9_onset_shifts", f"WITH {SHIFTS} SELECT anomaly_id, service, md5(template) AS digest, count_before, count_after, is_new, round(ratio, 6) AS ratio FROM sharp")
def cr9b(spark, sf_dir):
    return onset_shifts(spark, sf_dir).select(
        F.col("incident").alias("anomaly_id"), "service", F.md5("template").alias("digest"), "count_before", "count_after", "is_new", F.round("ratio", 6).alias("ratio"))


CONTEXT = """incident_id string, cluster string, anomaly struct<signal:string, metric:string, service:string, started_at:string, severity:string,
 baseline:struct<p50:double, p99:double>, observed:struct<p50:double, p99:double>, duration_so_far_s:double>,
 topology struct<affected_service:string, upstream_callers:array<string>, downstream_deps:array<string>>,
 log_pattern_deltas array<struct<service:string, template:string, count_before:bigint, count_after:bigint, example_fields:map<string,string>>>,
 ranked_candidate_causes array<struct<rank:int, score:double, kind:string, change_event_id:bigint, cause_service:string, summary:string, diff_summary:string>>,
 similar_past_incidents array<struct<incident_id:string, similarity:double, resolution:string>>"""


@query("cr9_incident_context", rf"""WITH {INCIDENT_PARTS}, {SHIFTS.replace('WITH ', '').lstrip()},
{KNN.format(on='q.vec_id % 100 = 0 AND p.label < 5 AND p.vec_id <> q.vec_id').replace('rk AS', 'past AS').lstrip()},
told AS (SELECT r.*, kind || ' of ' || cause_service || ' at ' || strftime(make_timestamp(c_us), '%H:%M:%S') || ' (T' || CASE WHEN c_us > a_us THEN '+' ELSE '-' END
  || CASE WHEN abs(c_us - a_us) // 1000000 >= 600 THEN (abs(c_us - a_us) // 60000000) || 'm' ELSE (abs(c_us - a_us) // 1000000) || 's' END || ')' AS summary,
  CASE WHEN kind = 'config_change' THEN 'k ' || ev.k END AS diff FROM ranked r JOIN ev ON ev.event_id = r.cand_id),
cs AS (SELECT anomaly_id, string_agg(cand_id || ' ' || summary || coalesce(': ' || diff, ''), '; ' ORDER BY "rank") AS causes FROM told GROUP BY 1),
sli AS (SELECT a.anomaly_id, round(quantile_cont(value, 0.5) FILTER (us < a_us), 4) AS baseline_p50, round(quantile_cont(value, 0.99) FILTER (us < a_us), 4) AS baseline_p99,
  round(quantile_cont(value, 0.5) FILTER (us >= a_us), 4) AS observed_p50, round(quantile_cont(value, 0.99) FILTER (us >= a_us), 4) AS observed_p99
  FROM anom a JOIN ev ON ev.service = a.service AND us BETWEEN a_us - 21600000000 AND a_us + 7200000000 GROUP BY 1),
fx AS (SELECT service, template, count(*) AS n FROM (
  SELECT replace(service, 'src', 'svc') AS service, template, unnest(string_split(template, ' ')) AS shown FROM (SELECT DISTINCT service, template FROM tp)) WHERE contains(shown, '<*>') GROUP BY ALL),
sh AS (SELECT anomaly_id, count(*) AS n_shifts, CAST(sum(count_before) AS BIGINT) AS shift_before, CAST(sum(count_after) AS BIGINT) AS shift_after, CAST(sum(coalesce(fx.n, 0)) AS BIGINT) AS n_fields,
  first(md5(sharp.template) ORDER BY round(abs(ln(ratio)), 9) DESC, sharp.template) AS sharpest FROM sharp LEFT JOIN fx ON fx.service = sharp.service AND fx.template = sharp.template GROUP BY 1),
sp AS (SELECT incident AS anomaly_id, string_agg('INC-' || past_incident || ' ' || (CAST(label AS VARCHAR)), ',' ORDER BY past.similarity DESC, past_incident) AS alike
  FROM past JOIN embeddings e ON e.vec_id = past_incident WHERE "rank" <= 3 GROUP BY 1)
SELECT a.anomaly_id, 'INC-' || a.anomaly_id AS incident_id, a.cluster, a.service, causes, baseline_p50, baseline_p99, observed_p50, observed_p99,
  'svc' || ((a.user_id + 9) % 10) AS callers, 'svc' || ((a.user_id + 1) % 10) AS deps,
  coalesce(n_shifts, 0) AS n_shifts, coalesce(shift_before, 0) AS shift_before, coalesce(shift_after, 0) AS shift_after, coalesce(n_fields, 0) AS n_fields, sharpest, coalesce(alike, '') AS alike
FROM anom a JOIN cs ON cs.anomaly_id = a.anomaly_id JOIN sli ON sli.anomaly_id = a.anomaly_id LEFT JOIN sh ON sh.anomaly_id = a.anomaly_id LEFT JOIN sp ON sp.anomaly_id = a.anomaly_id""")
def cr9(spark, sf_dir):
    """The documents of all incidents with causes, read back field by field; similar ones are searched for active incidents."""
    ev = twins.events(spark, sf_dir)
    diffs = ev.filter("event_type = 'purchase'").select(F.col("event_id").alias("change_event_id"), F.concat(F.lit("k "), F.col("k").cast("string")).alias("diff_summary"))
    incidents = cr.build_incidents(cr.told_causes(twins.ranked_causes(ev), diffs)).withColumn(
        "incident_id", F.concat(F.lit("INC-"), F.col("anomaly_id").cast("string")))
    onsets = twins.anomalies(ev).select("anomaly_id", "service", F.col("a_us").alias("onset"))
    sli = sli_summary(onsets.withColumnRenamed("anomaly_id", "incident_id"), ev, ["service"], "onset", "us", "value", BEFORE_S, AFTER_S)
    facts = onsets.join(sli.withColumnRenamed("incident_id", "anomaly_id"), "anomaly_id").select(
        "anomaly_id", F.lit("error rate spike").alias("signal"), F.lit("error_total").alias("metric"), F.lit("critical").alias("severity"),
        from_micros(F.col("onset")).alias("started_at"),
        *[F.struct(F.round(f"{n}_p50", 4).alias("p50"), F.round(f"{n}_p99", 4).alias("p99")).alias(n) for n in ("baseline", "observed")],
        F.lit(float(AFTER_S)).alias("duration_so_far_s"))
    slices = gr.topology_slice(twins.ring(ev), ev.select("service"))
    logs = service_logs(spark, sf_dir)
    fields = templates.example_fields(logs).select("service", "template", F.col("fields").cast("map<string,string>").alias("example_fields"))

    def deltas(rows):
        return onset_shifts(spark, sf_dir, fields, rows.withColumnRenamed("anomaly_id", "incident")).withColumnsRenamed({"incident": "anomaly_id", "shifts": "log_pattern_deltas"})

    vectors = twins.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("incident"), F.col("embedding").alias("vector"), (F.col("label") < 5).alias("resolved"), "label")
    resolutions = vectors.select(F.col("incident").alias("past_incident"), F.col("label").cast("string").alias("resolution"))
    similar = retrieve.similar_incidents(vectors.filter("incident % 100 = 0"), vectors).join(resolutions, "past_incident").select(
        F.col("incident").alias("anomaly_id"), F.concat(F.lit("INC-"), F.col("past_incident").cast("string")).alias("incident_id"), "similarity", "resolution")
    doc = cr.incident_context(incidents, facts, slices, deltas, similar).withColumn("d", F.from_json("document", CONTEXT))
    causes, shifts = F.col("d.ranked_candidate_causes"), F.col("d.log_pattern_deltas")

    def total(name):
        return F.aggregate(shifts, F.lit(0).cast("long"), lambda acc, x: acc + x[name])

    return doc.select(
        "anomaly_id", "d.incident_id", "d.cluster", F.col("d.anomaly.service").alias("service"),
        F.array_join(F.transform(causes, lambda c: F.concat(c["change_event_id"].cast("string"), F.lit(" "), c["summary"], F.coalesce(F.concat(F.lit(": "), c["diff_summary"]), F.lit("")))), "; ").alias("causes"),
        *[F.col(f"d.anomaly.{n}.{q}").alias(f"{n}_{q}") for n in ("baseline", "observed") for q in ("p50", "p99")],
        F.array_join("d.topology.upstream_callers", ",").alias("callers"), F.array_join("d.topology.downstream_deps", ",").alias("deps"),
        F.size(shifts).cast("long").alias("n_shifts"), total("count_before").alias("shift_before"), total("count_after").alias("shift_after"),
        F.aggregate(shifts, F.lit(0).cast("long"), lambda acc, x: acc + F.coalesce(F.size(x["example_fields"]), F.lit(0))).alias("n_fields"),
        F.md5(F.get(shifts, F.lit(0))["template"]).alias("sharpest"),
        F.array_join(F.transform("d.similar_past_incidents", lambda s: F.concat(s["incident_id"], F.lit(" "), s["resolution"])), ",").alias("alike"))


KINDS = {"metric": "view", "change": "purchase", "event": "error", "log": "click"}


@query("cr10_incident_timeline", f"""WITH {EVENTS},
t AS (SELECT 'INC-' || user_id || '-' || (us // 86400000000) AS incident_id, us, event_id AS entry_id,
  CASE event_type WHEN 'view' THEN 'metric' WHEN 'purchase' THEN 'change' WHEN 'error' THEN 'event' ELSE 'log' END AS kind
  FROM ev WHERE event_type <> 'signup')
SELECT incident_id, kind, entry_id, row_number() OVER (PARTITION BY incident_id ORDER BY us, kind, entry_id) AS position FROM t""")
def cr10(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    day = F.floor(F.col("us") / (86_400 * SECOND)).cast("string")
    rows = ev.select(F.concat(F.lit("INC-"), F.col("user_id").cast("string"), F.lit("-"), day).alias("incident_id"), "us",
                     F.col("event_id").alias("entry_id"), "event_type", F.lit("x").alias("text"))
    parts = {kind: rows.filter(F.col("event_type") == name) for kind, name in KINDS.items()}
    return cr.incident_timeline(parts).select("incident_id", "kind", "entry_id", "position")


@query("cr11_incident_list", f"""WITH {EVENTS}
SELECT event_id, service, value FROM ev WHERE event_type = 'error' AND service = 'svc3' ORDER BY value DESC, event_id LIMIT 20 OFFSET 20""")
def cr11(spark, sf_dir):
    rows = twins.events(spark, sf_dir).filter("event_type = 'error'").select("event_id", "service", "value")
    return cr.incident_page(rows, [F.desc("value"), F.asc("event_id")], 1, 20, F.col("service") == "svc3")


@query("cr11_incident_detail", f"""WITH {INCIDENT_PARTS}, one AS (SELECT min(anomaly_id) AS id FROM ranked)
SELECT anomaly_id, count(*) AS n_causes, arg_min(cand_id, "rank") AS best FROM ranked WHERE anomaly_id = (SELECT id FROM one) GROUP BY 1""")
def cr11b(spark, sf_dir):
    """One incident by its id, here the smallest that has causes."""
    rows = materialise(cr.build_incidents(twins.ranked_causes(twins.events(spark, sf_dir))), "incidents")
    one = cr.incident_detail(rows, rows.agg(F.min("anomaly_id")).first()[0], "anomaly_id")
    return one.select("anomaly_id", F.size("ranked_candidate_causes").cast("long").alias("n_causes"), F.get("ranked_candidate_causes", F.lit(0))["change_event_id"].alias("best"))


@query("ag3_union_candidates", f"""WITH {INCIDENT_PARTS},
u AS (SELECT kind, cluster FROM cand UNION ALL SELECT 'k8s_event', cluster FROM ev WHERE event_type = 'view'
      UNION ALL SELECT 'log_template', NULL FROM documents)
SELECT kind, cluster, count(*) AS n FROM u GROUP BY 1, 2""")
def ag3(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    k8s = ev.filter("event_type = 'view'").select(F.col("event_id").alias("cand_id"), "cluster", "service", F.col("us").alias("c_us"))
    shifts = twins.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("cand_id"), F.lit(None).cast("string").alias("cluster"), F.col("source").alias("service"),
        F.lit(0).cast("long").alias("c_us"))
    rows = cr.union_candidates(changes=twins.candidates(ev), k8s_event=k8s, log_template=shifts)
    return rows.groupBy("kind", "cluster").agg(F.count(F.lit(1)).alias("n"))


EVERY_CAUSE = (INCIDENT_PARTS.replace("pairs AS (", """every_cand AS (
  SELECT CAST(cand_id AS VARCHAR) AS cand_id, cluster, service, c_us, kind FROM cand
  UNION ALL SELECT CAST(event_id AS VARCHAR), cluster, service, us, 'k8s_event' FROM ev WHERE event_type = 'view'
  UNION ALL SELECT 'tpl-' || md5(service || ' ' || template), 'c' || (length(template) % 3), replace(service, 'src', 'svc'), epoch_us(min(ts)), 'log_template' FROM tp GROUP BY service, template),
pairs AS (""", 1).replace("JOIN cand c ON", "JOIN every_cand c ON").replace(
    "CASE WHEN p.kind = 'deploy' THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END AS fk",
    "CASE p.kind WHEN 'deploy' THEN 1.0::DOUBLE WHEN 'config_change' THEN 0.6::DOUBLE WHEN 'k8s_event' THEN 0.4::DOUBLE ELSE 0.3::DOUBLE END AS fk"))


@query("ag3_rank_all_kinds", f"""WITH {TEMPLATES.lstrip()}, {EVERY_CAUSE.lstrip()}
SELECT anomaly_id, "rank", cand_id, kind, cause_service, score FROM ranked""")
def ag3c(spark, sf_dir):
    """Changes, cluster events and first sights of log templates ranked together, each at its own time."""
    ev = twins.events(spark, sf_dir)
    k8s = ev.filter("event_type = 'view'").select(F.col("event_id").alias("cand_id"), "cluster", "service", F.col("us").alias("c_us"))
    seen = templates.mine_templates(lines(spark, sf_dir)).select(
        F.concat(F.lit("tpl-"), F.md5(F.concat("service", F.lit(" "), "template"))).alias("cand_id"),
        F.concat(F.lit("c"), (F.length("template") % 3).cast("string")).alias("cluster"),
        F.regexp_replace("service", "src", "svc").alias("service"), micros(F.col("first_seen")).alias("c_us"))
    rows = materialise(cr.union_candidates(changes=twins.candidates(ev), k8s_event=k8s, log_template=seen), "candidates")
    ranked = cr.rank_causes(twins.anomalies(ev), rows, twins.distances(ev), cr.history(twins.feedback(ev)))
    return ranked.select("anomaly_id", "rank", "cand_id", "kind", "cause_service", "score")


@query("ag3_union_signals", f"""WITH {EVENTS}
SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS tier, event_type = 'view' AS has_iso, count(*) AS n
FROM ev WHERE event_type IN ('error', 'view') GROUP BY 1, 2""")
def ag3b(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    one = ev.filter("event_type = 'error'").select("event_id", F.lit(1).alias("tier"))
    two = ev.filter("event_type = 'view'").select("event_id", F.lit(2).alias("tier"), (-F.col("value")).alias("iso_score"))
    rows = cr.union_signals(one, two)
    return rows.groupBy("tier", F.col("iso_score").isNotNull().alias("has_iso")).agg(F.count(F.lit(1)).alias("n"))


@query("jn2_fuse_tiers", f"""WITH {EVENTS},
b AS (
  SELECT 'm' || (k % 3) AS metric, cluster, CASE WHEN k % 5 <> 0 THEN 'ns' || (k % 2) END AS namespace, service, event_id,
    us - 300000000 AS s, CASE WHEN event_type = 'error' THEN us + 36000000000 ELSE us + 7200000000 END AS e, CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS tier
  FROM ev WHERE event_type IN ('error', 'purchase')),
r AS (SELECT *, max(e) OVER (PARTITION BY metric, cluster, namespace, service ORDER BY s, tier, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR s > reach THEN 1 ELSE 0 END) OVER (PARTITION BY metric, cluster, namespace, service ORDER BY s, tier, event_id) AS isl FROM r)
SELECT metric, cluster, namespace, service, min(s) AS start_us, max(e) AS end_us, count(*) FILTER (tier = 1) AS n_tier1, count(*) FILTER (tier = 2) AS n_tier2
FROM g GROUP BY metric, cluster, namespace, service, isl""")
def jn2(spark, sf_dir):
    ev = twins.events(spark, sf_dir)

    def tier(name, hours):
        return ev.filter(F.col("event_type") == name).select(
            F.concat(F.lit("m"), (F.col("k") % 3).cast("string")).alias("metric"), "cluster",
            F.when(F.col("k") % 5 != 0, F.concat(F.lit("ns"), (F.col("k") % 2).cast("string"))).alias("namespace"), "service",
            F.col("event_id").alias("anomaly_id"), (F.col("us") - 300 * SECOND).alias("start_us"),
            (F.col("us") + hours * 3600 * SECOND).alias("end_us"))

    return jn.fuse_tiers(tier("error", 10), tier("purchase", 2))


@query("jn5_embed_worklist", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def jn5(spark, sf_dir):
    docs = twins.table(spark, sf_dir, "documents").select("doc_id")
    done = twins.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return jn.embed_worklist(docs, done, ["doc_id"])


@query("jn6_candidate_diffs", """SELECT l_orderkey, l_linenumber, l_partkey AS change_event_id, p_name AS diff_summary
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size % 2 = 0""")
def jn6(spark, sf_dir):
    causes = twins.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("change_event_id"))
    diffs = twins.table(spark, sf_dir, "part").filter("p_size % 2 = 0").select(
        F.col("p_partkey").alias("change_event_id"), F.col("p_name").alias("diff_summary"))
    return jn.candidate_diffs(causes, diffs)


@query("jn7_after_deploy", f"""WITH {EVENTS},
seen AS (SELECT service, k, min(us) AS first_us FROM ev WHERE event_type = 'view' GROUP BY 1, 2),
ch AS (SELECT service, us AS change_us, event_id AS change_id FROM ev WHERE event_type = 'purchase')
SELECT seen.service, k, first_us, change_us, change_id FROM seen ASOF LEFT JOIN ch ON seen.service = ch.service AND first_us >= change_us""")
def jn7(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    seen = ev.filter("event_type = 'view'").groupBy("service", "k").agg(F.min("us").alias("first_us"))
    changes = ev.filter("event_type = 'purchase'").select("service", F.col("us").alias("change_us"), F.col("event_id").alias("change_id"))
    return jn.after_deploy(seen, changes)


def requests(spark, sf_dir):
    """Line items as requests from the customer's nation to the supplier's."""
    item = twins.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("ts"))
    orders = twins.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = twins.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("c_n"))
    supp = twins.table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("s_n"))
    rows = item.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(cust, F.col("o_custkey") == F.col("c_custkey")) \
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select("ts", F.concat(F.lit("n"), F.col("c_n").cast("string")).alias("src"),
                       F.concat(F.lit("n"), F.col("s_n").cast("string")).alias("dst"))


REQUESTS = """
rq AS (SELECT l_shipdate AS ts, 'n' || c_nationkey AS src, 'n' || s_nationkey AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""


@query("gr1_service_edges", f"""WITH {REQUESTS}
SELECT time_bucket(INTERVAL 30 SECOND, ts) AS window_start, src, dst, round(count(*) / 30.0::DOUBLE, 9) AS weight FROM rq GROUP BY 1, 2, 3""")
def gr1(spark, sf_dir):
    rows = gr.service_edges(requests(spark, sf_dir))
    return rows.select(ntz(F.col("window_start")).alias("window_start"), "src", "dst", F.round("weight", 9).alias("weight"))


def graph_edges(spark, sf_dir):
    """A naturally sparse graph, all of it: customers and suppliers call their nation, nations their region."""
    cust = twins.table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("src"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("dst"))
    supp = twins.table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")))
    nation = twins.table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")))
    return cust.union(supp).union(nation).distinct()


GRAPH = """
hv AS (SELECT 'c' || c_custkey AS src, 'n' || c_nationkey AS dst FROM customer UNION SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier
       UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
nd AS (SELECT DISTINCT src AS s FROM hv),
wk AS (SELECT s AS source, s AS node, 0 AS distance FROM nd
       UNION SELECT wk.source, hv.dst, wk.distance + 1 FROM wk JOIN hv ON wk.node = hv.src WHERE wk.distance < 3),
wd AS (SELECT source, node, min(distance) AS distance FROM wk GROUP BY 1, 2)"""


@query("gr2_walk", f"WITH RECURSIVE {GRAPH} SELECT source, node, distance FROM wd")
def gr2(spark, sf_dir):
    edges = graph_edges(spark, sf_dir)
    return gr.walk(edges, edges.select(F.col("src").alias("source")), 3).select("source", "node", "distance")


@query("gr3_topology_slice", f"""WITH RECURSIVE {GRAPH}
SELECT s AS service, (SELECT string_agg(DISTINCT src, ',' ORDER BY src) FROM hv WHERE dst = s) AS callers,
  (SELECT string_agg(DISTINCT dst, ',' ORDER BY dst) FROM hv WHERE src = s) AS deps FROM nd""")
def gr3(spark, sf_dir):
    edges = graph_edges(spark, sf_dir)
    rows = gr.topology_slice(edges, edges.select(F.col("src").alias("service")))

    def text(c):
        return F.when(F.size(c) > 0, F.array_join(c, ","))

    return rows.select("service", text("upstream_callers").alias("callers"), text("downstream_deps").alias("deps"))


@query("gr4_topo_distance", f"""WITH RECURSIVE {GRAPH},
pr AS (SELECT DISTINCT 'c' || c_custkey AS service, 'r' || (c_custkey % 5) AS cause_service FROM customer)
SELECT service, cause_service, least(a.distance, b.distance) AS distance FROM pr
LEFT JOIN (SELECT * FROM wd WHERE distance <= 2) a ON a.source = service AND a.node = cause_service
LEFT JOIN (SELECT * FROM wd WHERE distance <= 2) b ON b.source = cause_service AND b.node = service""")
def gr4(spark, sf_dir):
    key = F.col("c_custkey")
    pairs = twins.table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), key.cast("string")).alias("service"), F.concat(F.lit("r"), (key % 5).cast("string")).alias("cause_service"))
    return gr.topo_distance(pairs, graph_edges(spark, sf_dir), 2)


@query("snk3_upsert_incidents", """SELECT o_custkey AS incident_id, o_orderkey, o_orderdate AS updated_at, o_totalprice AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def snk3(spark, sf_dir):
    """Three upserts into a table on disk: the newest row of each incident, whenever it came."""
    rows = twins.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("incident_id"), "o_orderkey", F.col("o_orderdate").alias("updated_at"), F.col("o_totalprice").alias("score"), "o_orderstatus")
    path = run_dir(spark, "incidents")
    for status in ("F", "O", "P"):
        table = upsert_incidents(rows.filter(F.col("o_orderstatus") == status).drop("o_orderstatus"), path, version=("updated_at", "o_orderkey"), buckets=8)
    return table.rows()


@query("snk4_expire", f"""WITH {EVENTS},
y AS (SELECT event_id, event_type, ts, sum(100 + k) OVER (PARTITION BY event_type ORDER BY us DESC, event_id) AS bytes FROM ev
      WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 168 HOUR)
SELECT event_id, event_type FROM y WHERE bytes <= 50000""")
def snk4(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    kept = expire(ev, "ts", F.lit("2024-01-31").cast("timestamp"), 168, 50_000, F.col("k") + 100, ["event_type"], ["event_id"])
    return kept.select("event_id", "event_type")


