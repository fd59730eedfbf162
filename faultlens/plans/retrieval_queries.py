"""Similarity search, document chunks, feedback and cost queries."""

from pyspark.sql import functions as F

from faultlens.functions.columns import SECOND
from faultlens.operators import correlate as cr
from faultlens.operators import feedback as fb
from faultlens.operators import retrieve as rt
from faultlens.plans import twins
from faultlens.plans.registry import query
from faultlens.plans.twins import EVENTS


def vectors(spark, sf_dir):
    return twins.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("incident"), F.col("embedding").alias("vector"), "label", (F.col("label") < 5).alias("resolved"))


def active(rows):
    """The incidents that are searched for: every hundredth, against all."""
    return rows.filter("incident % 100 = 0")


KNN = """
vc AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
sm AS (SELECT q.vec_id AS incident, p.vec_id AS past_incident, round(list_cosine_similarity(q.v, p.v), 6) AS similarity
  FROM vc q JOIN vc p ON {on}),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY incident ORDER BY similarity DESC, past_incident) AS INTEGER) AS "rank" FROM sm)"""


@query("rt1_similar_incidents", f"""WITH {KNN.format(on='q.vec_id % 100 = 0 AND p.label < 5 AND p.vec_id <> q.vec_id')}
SELECT incident, past_incident, similarity, "rank" FROM rk WHERE "rank" <= 3""")
def rt1(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    return rt.similar_incidents(active(rows), rows)


@query("rt2_runbook_chunks", f"""WITH {KNN.format(on='q.vec_id % 100 = 0 AND p.label = q.label AND p.vec_id % 2 = q.vec_id % 2 AND p.vec_id % 3 = 0')}
SELECT incident, past_incident AS chunk_id, similarity, "rank" FROM rk WHERE "rank" <= 3""")
def rt2(spark, sf_dir):
    rows = vectors(spark, sf_dir).withColumn("service", F.concat(F.lit("s"), F.col("label").cast("string"))) \
        .withColumn("signal_type", (F.col("incident") % 2).cast("string"))
    chunks = rows.filter("incident % 3 = 0").withColumnRenamed("incident", "chunk_id")
    return rt.runbook_chunks(active(rows), chunks)


@query("rt3_chunk_documents", """SELECT doc_id, CAST(n AS INTEGER) AS chunk_no, md5(substring(text, n * 700 + 1, 800)) AS digest
FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 101, 0) // 700)) AS n FROM documents WHERE length(text) > 0)""")
def rt3(spark, sf_dir):
    docs = twins.table(spark, sf_dir, "documents").select("doc_id", "text")
    return rt.chunk_documents(docs, "text").select("doc_id", "chunk_no", F.md5("chunk").alias("digest"))


def _searchable(rows):
    queries = active(rows).select(F.col("incident").alias("q_id"), F.lit("").alias("grp"), F.col("vector").alias("q_vec"))
    items = rows.select(F.col("incident").alias("i_id"), F.lit("").alias("grp"), F.col("vector").alias("i_vec"))
    return queries, items


@query("rt4_exact_lists", f"""WITH {KNN.format(on='q.vec_id % 100 = 0 AND p.vec_id <> q.vec_id')}
SELECT incident, past_incident, similarity, "rank" FROM rk WHERE "rank" <= 3""")
def rt4(spark, sf_dir):
    """Exact search in blocks."""
    queries, items = _searchable(vectors(spark, sf_dir))
    found = rt.nearest(queries, items, 3, exclude_self=True)
    return found.select(F.col("q_id").alias("incident"), F.col("i_id").alias("past_incident"), "similarity", "rank")


LISTS = """
vc AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
ct AS (SELECT CAST(row_number() OVER (ORDER BY sha256('42|' || vec_id), vec_id) - 1 AS INTEGER) AS list, v FROM vc
       ORDER BY sha256('42|' || vec_id), vec_id LIMIT 20),
near AS (SELECT vec_id, vc.v, list, list_cosine_similarity(vc.v, ct.v) AS sim FROM vc CROSS JOIN ct),
own AS (SELECT vec_id, any_value(v) AS v, arg_max(list, sim) AS list, max(sim) AS sim FROM near GROUP BY 1)"""


@query("rt4_ivf_assign", f"WITH {LISTS} SELECT vec_id AS i_id, list, round(least(sim, 1.0), 5) AS cosine FROM own")
def rt4b(spark, sf_dir):
    _, items = _searchable(vectors(spark, sf_dir))
    centroids = rt.sample_centroids(items, "i_id", "i_vec", 20)
    return rt.ivf_assign(items, "i_id", "i_vec", centroids).select("i_id", "list", F.round(F.cos("angle"), 5).alias("cosine"))


@query("rt4_ivf_probe", f"""WITH {LISTS},
ask AS (SELECT vec_id, v, list FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC) AS rn FROM near WHERE vec_id % 100 = 0) WHERE rn <= 8),
sm AS (SELECT a.vec_id AS q_id, o.vec_id AS i_id, round(list_cosine_similarity(a.v, o.v), 6) AS similarity FROM ask a JOIN own o ON a.list = o.list AND a.vec_id <> o.vec_id),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY q_id ORDER BY similarity DESC, i_id) AS INTEGER) AS "rank" FROM sm)
SELECT q_id, i_id, similarity, "rank" FROM rk WHERE "rank" <= 3""")
def rt4c(spark, sf_dir):
    queries, items = _searchable(vectors(spark, sf_dir))
    return rt.nearest(queries, items, 3, exclude_self=True, lists=20, probes=8)


@query("fb1_shadow_sample", """SELECT event_id FROM events
WHERE CAST('0x' || substr(sha256(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 10""")
def fb1(spark, sf_dir):
    return fb.shadow_sample(twins.table(spark, sf_dir, "events").select("event_id"), "event_id")


@query("fb2_shadow_metrics", """WITH r AS (SELECT doc_id // 10 AS i, doc_id, quality, row_number() OVER (PARTITION BY doc_id // 10 ORDER BY toxic DESC, doc_id) AS rn FROM labels),
t AS (SELECT count(*) AS confirmed FROM labels WHERE quality = 1),
k AS (SELECT unnest([1, 3, 5])::BIGINT AS k)
SELECT k, count(*) FILTER (quality = 1) AS hits, round(count(*) FILTER (quality = 1) / count(*)::DOUBLE, 9) AS "precision",
  round(count(*) FILTER (quality = 1) / max(confirmed)::DOUBLE, 9) AS recall FROM r JOIN k ON rn <= k CROSS JOIN t WHERE rn <= 5 GROUP BY 1""")
def fb2(spark, sf_dir):
    rows = twins.table(spark, sf_dir, "labels").select(
        F.floor(F.col("doc_id") / 10).alias("incident_id"), F.col("doc_id").alias("cause_id"), "quality", "toxic")
    ranked = cr.top_causes(rows, ["incident_id"], [F.desc("toxic"), F.asc("cause_id")])
    out = fb.shadow_metrics(ranked, rows.filter("quality = 1"))
    return out.select("k", "hits", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query("fb3_calibration_bands", """WITH j AS (SELECT (doc_id * 37 % 101) / 100.0::DOUBLE AS c, quality FROM labels)
SELECT CASE WHEN c >= 0.8::DOUBLE THEN 'aligned' WHEN c >= 0.5::DOUBLE THEN 'likely' WHEN c >= 0.2::DOUBLE THEN 'lead' ELSE 'needs more data' END AS band,
  count(*) AS n, round(avg(quality), 9) AS hit_rate, round(avg(c), 9) AS mean_confidence FROM j GROUP BY 1""")
def fb3(spark, sf_dir):
    rows = twins.table(spark, sf_dir, "labels").select(
        ((F.col("doc_id") * 37 % 101) / 100).alias("confidence"), (F.col("quality") == 1).alias("correct"))
    out = fb.calibration_bands(rows)
    return out.select("band", "n", F.round("hit_rate", 9).alias("hit_rate"), F.round("mean_confidence", 9).alias("mean_confidence"))


@query("fb4_notify_candidates", f"""WITH {EVENTS} SELECT event_id AS incident_id FROM ev WHERE event_type = 'error' AND value / 100 > 0.7::DOUBLE AND k % 3 <> 0""")
def fb4(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    incidents = ev.filter("event_type = 'error'").select(F.col("event_id").alias("incident_id"), (F.col("value") / 100).alias("confidence"))
    notified = ev.filter("k % 3 = 0").select(F.col("event_id").alias("incident_id"))
    return fb.notify_candidates(incidents, notified).select("incident_id")


def hypotheses(spark, sf_dir):
    """Model answers with one kind of fault each, by the number in ``props``."""
    ev = twins.events(spark, sf_dir)
    n = F.col("k") % 7
    cause = F.when(n == 5, "elsewhere").otherwise(F.concat(F.lit("c"), (F.col("event_id") % 10).cast("string")))
    step = F.when(n == 3, "drain node pool").when(n == 4, "REQUIRES HUMAN CONFIRMATION drain node pool").otherwise("roll back")
    one = F.struct(
        F.when(n == 2, 2).otherwise(1).alias("rank"), cause.alias("cause"), F.when(n == 1, 1.2).otherwise(0.6).alias("confidence"),
        F.array(F.struct(step.alias("step"), F.lit("low").alias("risk"), F.lit(True).alias("reversible"))).alias("suggested_remediation"))
    text = F.when(n == 6, "not json").otherwise(F.to_json(F.struct(F.lit("s").alias("summary"), F.array(one).alias("hypotheses"))))
    answers = ev.select(F.col("event_id").alias("incident_id"), text.alias("value"))
    known = ev.select(F.col("event_id").alias("incident_id"), F.concat(F.lit("c"), (F.col("event_id") % 10).cast("string")).alias("cause"))
    return answers, known


@query("fb5_validate_hypotheses", f"""WITH {EVENTS}
SELECT event_id AS incident_id, CASE k % 7 WHEN 1 THEN 'confidence' WHEN 2 THEN 'rank order' WHEN 3 THEN 'unconfirmed step'
  WHEN 5 THEN 'unknown cause' WHEN 6 THEN 'schema' ELSE '' END AS problems FROM ev""")
def fb5(spark, sf_dir):
    answers, known = hypotheses(spark, sf_dir)
    return fb.validate_hypotheses(answers, known).select("incident_id", F.array_join("problems", ",").alias("problems"))


@query("fb6_call_budget", """SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS call_no,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) > 6 AS over_budget FROM conversations""")
def fb6(spark, sf_dir):
    calls = twins.table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("turn") * SECOND).alias("us"))
    return fb.call_budget(calls, ["conv_id"], "us", [], chunk_us=4 * SECOND).select("conv_id", "turn", "call_no", "over_budget")


def model_calls(spark, sf_dir):
    return twins.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("incident_id"), F.col("l_returnflag").alias("model"), F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").cast("long").alias("tokens"), (F.col("l_extendedprice") / 1_000_000).alias("usd"))


@query("fb7_cost_rollup", """SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag AS model, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS tokens,
  round(sum(l_extendedprice / 1000000), 8) AS usd, count(*) AS calls FROM lineitem GROUP BY ROLLUP (1, 2)""")
def fb7(spark, sf_dir):
    return fb.cost_rollup(model_calls(spark, sf_dir)).withColumn("usd", F.round("usd", 8))


@query("fb7_costly_incidents", """SELECT l_orderkey AS incident_id, round(sum(l_extendedprice / 1000000), 8) AS usd, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS tokens
FROM lineitem GROUP BY 1 HAVING sum(l_extendedprice / 1000000) > 0.15""")
def fb7b(spark, sf_dir):
    return fb.costly_incidents(model_calls(spark, sf_dir)).withColumn("usd", F.round("usd", 8))


@query("fb8_analysis_status", """SELECT o_orderkey AS incident_id, CASE WHEN a.answered THEN 'available' WHEN NOT a.answered THEN 'pending' ELSE 'unavailable' END AS status
FROM orders LEFT JOIN (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS answered FROM lineitem WHERE l_quantity < 15 GROUP BY 1) a ON o_orderkey = l_orderkey""")
def fb8(spark, sf_dir):
    incidents = twins.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("incident_id"))
    analyses = twins.table(spark, sf_dir, "lineitem").filter("l_quantity < 15").select(
        F.col("l_orderkey").alias("incident_id"), (F.col("l_returnflag") == "R").alias("answered"))
    return fb.analysis_status(incidents, analyses)
