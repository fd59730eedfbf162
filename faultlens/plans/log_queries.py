"""Log shaping, masking and template queries over documents and event-made lines."""

from pyspark.sql import functions as F

from faultlens.functions import text as tx
from faultlens.functions.columns import ntz
from faultlens.operators import joins as jn
from faultlens.operators import logs as lg
from faultlens.operators import templates as tm
from faultlens.plans import twins
from faultlens.plans.registry import query
from faultlens.session import run_dir
from faultlens.sources.records import read_k8s_events, read_log_topics
from faultlens.sources.sinks import write_parsed_log_files

DEPARTMENTS = ["core", "edge"]


def log_records(spark, sf_dir):
    """One record per event on a topic of its kind; errors are plain text on a JSON topic."""
    ev = twins.events(spark, sf_dir)
    s, kind = F.lit, F.col("event_type")
    user, k, event_id = (F.col(c).cast("string") for c in ("user_id", "k", "event_id"))
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    logfmt = F.concat(s("ts="), at, s(' level=warn msg="user '), user, s(' said \\"hi\\"" namespace=ns1 k=0 k='), k, s(" note="))
    access = F.concat(s("10.0.0."), k, s(":33317 ["), at, s("] http-in pool"), k, s("/srv1 10/0/30/69/109 "), (F.col("k") + 200).cast("string"),
                      s(' 2750 - - ---- 1/1/1/1/0 0/0 "GET /u/'), user, s(' HTTP/1.1"'))
    doc = F.concat(s('{"timestamp":"'), at, s('","level":"ERROR","message":"mail u'), user, s('@example.com","service":"'), F.col("service"),
                   s('","pod":"p'), k, s('","tries":'), k, s("}"))
    stack = F.concat(s('Exception in thread "main" com.acme.Svc'), k, s("Exception: no "), user, s("\n\tat a.B.c(B.java:1)\n\tat d.E.f(E.java:2)"))
    text = F.when(kind == "signup", logfmt).when(kind == "purchase", access).when(kind == "view", doc).when(kind == "click", stack) \
        .otherwise(F.concat(s("plain text "), event_id))
    prefix = F.when(kind == "signup", "linkerd-proxy-").when(kind == "purchase", "haproxy-").when(kind == "click", "java-").otherwise("app-")
    record = F.to_json(F.struct(
        text.alias("log"), s("prod").alias("environment"),
        F.when(F.col("user_id") % 4 == 0, "core").when(F.col("user_id") % 4 == 1, "edge").otherwise("retail").alias("department"),
        F.concat(s("ship"), k).alias("pod"),
        F.concat(s("nation_"), (F.col("user_id") % 25).cast("string"), s("-h"), k).alias("host"),
        F.when(F.col("k") % 2 == 0, F.col("cluster")).alias("cluster")))
    return ev.select("event_id", F.concat(prefix, F.col("service")).alias("topic"), record.alias("value"))


def raw_logs(spark, sf_dir):
    return read_log_topics(log_records(spark, sf_dir))


def kind_of(kind):
    return {"logfmt": "signup", "haproxy": "purchase", "json": "view", "stacktrace": "click"}[kind]


def parsed(spark, sf_dir, kind):
    good, _ = lg.dispatch_parse(raw_logs(spark, sf_dir))
    return good.filter(F.col("format") == kind)


LOGS = twins.EVENTS + """,
lg AS (SELECT *, 'nation_' || (user_id % 25) || '-h' || k AS node, CASE WHEN k % 2 = 0 THEN cluster END AS given,
  CASE user_id % 4 WHEN 0 THEN 'core' WHEN 1 THEN 'edge' ELSE 'retail' END AS dept,
  CASE event_type WHEN 'signup' THEN 'linkerd-proxy-' WHEN 'purchase' THEN 'haproxy-' WHEN 'click' THEN 'java-' ELSE 'app-' END || service AS topic
  FROM ev)"""


@query("src4_read_log_topics", f"""WITH {LOGS}
SELECT topic AS source_topic, dept, count(*) AS n, count(given) AS n_cluster FROM lg GROUP BY 1, 2""")
def src4(spark, sf_dir):
    return raw_logs(spark, sf_dir).groupBy("source_topic", F.col("department").alias("dept")).agg(
        F.count(F.lit(1)).alias("n"), F.count("given_cluster").alias("n_cluster"))


@query("src5_read_k8s_events", f"""WITH {twins.EVENTS}
SELECT event_id, CASE WHEN event_type = 'error' THEN 'Warning' ELSE 'Normal' END AS kind, event_type AS reason, ts,
  service AS workload, cluster FROM ev WHERE event_type <> 'view'""")
def src5(spark, sf_dir):
    return k8s_events(spark, sf_dir).select("event_id", "kind", "reason", ntz(F.col("ts")).alias("ts"), "workload", "cluster")


def k8s_events(spark, sf_dir):
    ev = twins.events(spark, sf_dir)
    kind = F.when(F.col("event_type") == "error", "Warning").when(F.col("event_type") == "view", "Other").otherwise("Normal")
    body = F.to_json(F.struct(
        kind.alias("type"), F.col("event_type").alias("reason"), F.lit("m").alias("message"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("lastTimestamp"),
        F.struct(F.lit("Deployment").alias("kind"), F.lit("ns").alias("namespace"), F.col("service").alias("name")).alias("involvedObject")))
    headers = F.array(F.struct(F.lit("cluster").alias("key"), F.col("cluster").cast("binary").alias("value")))
    return read_k8s_events(ev.select("event_id", body.alias("value"), headers.alias("headers")))


@query("jn3_allowlist_semi_join", f"""WITH {LOGS}
SELECT event_id, topic AS source_topic, dept FROM lg WHERE dept IN ('core', 'edge')
 AND topic IN (SELECT topic FROM lg WHERE k = 7 AND user_id % 2 = 0)""")
def jn3(spark, sf_dir):
    logs = raw_logs(spark, sf_dir)
    ev = twins.events(spark, sf_dir).filter("k = 7 AND user_id % 2 = 0").select("event_id")
    topics = log_records(spark, sf_dir).join(ev, "event_id").select(F.col("topic").alias("source_topic"))
    return jn.allowlist_semi_join(logs, topics, DEPARTMENTS).select("event_id", "source_topic", F.col("department").alias("dept"))


@query("jn4_cluster_lookup", f"""WITH {LOGS},
pat AS (SELECT 'nation_' || n_nationkey AS prefix, n_name AS cluster FROM nation WHERE n_nationkey < 20
        UNION ALL SELECT 'nation_', 'fallback'),
hit AS (SELECT event_id, arg_max(pat.cluster, length(prefix)) AS found FROM lg JOIN pat ON starts_with(node, prefix) WHERE given IS NULL GROUP BY 1)
SELECT event_id, coalesce(given, found) AS cluster FROM lg LEFT JOIN hit USING (event_id)""")
def jn4(spark, sf_dir):
    nation = twins.table(spark, sf_dir, "nation").filter("n_nationkey < 20")
    patterns = nation.select(F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string")).alias("prefix"), F.col("n_name").alias("cluster"))
    patterns = patterns.unionByName(nation.select(F.lit("nation_").alias("prefix"), F.lit("fallback").alias("cluster")).distinct())
    return jn.cluster_lookup(raw_logs(spark, sf_dir), patterns).select("event_id", "cluster")


@query("lg1_dispatch_parse", f"""WITH {LOGS}
SELECT CASE event_type WHEN 'signup' THEN 'logfmt' WHEN 'purchase' THEN 'haproxy' WHEN 'click' THEN 'stacktrace' ELSE 'json' END AS format,
  event_type <> 'error' AS parsed, count(*) AS n FROM lg GROUP BY 1, 2""")
def lg1(spark, sf_dir):
    good, bad = lg.dispatch_parse(raw_logs(spark, sf_dir))
    both = good.select("format", F.lit(True).alias("parsed")).unionByName(bad.select("format", F.lit(False).alias("parsed")))
    return both.groupBy("format", "parsed").agg(F.count(F.lit(1)).alias("n"))


@query("lg2_parse_logfmt", f"""WITH {LOGS}
SELECT event_id, 'user ' || user_id || ' said "hi"' AS msg, CAST(k AS VARCHAR) AS k, '' AS note, 6::BIGINT AS n_fields FROM lg WHERE event_type = 'signup'""")
def lg2(spark, sf_dir):
    f = F.col("fields")
    return parsed(spark, sf_dir, "logfmt").select(
        "event_id", f["msg"].alias("msg"), f["k"].alias("k"), f["note"].alias("note"), F.size(f).cast("long").alias("n_fields"))


@query("lg3_parse_haproxy", f"""WITH {LOGS}
SELECT event_id, '10.0.0.' || k AS client_ip, 'pool' || k AS backend, CAST(k + 200 AS VARCHAR) AS status, '/u/' || user_id AS path, '109' AS t_total
FROM lg WHERE event_type = 'purchase'""")
def lg3(spark, sf_dir):
    names = ["client_ip", "backend", "status", "path", "t_total"]
    return parsed(spark, sf_dir, "haproxy").select("event_id", *[F.col("fields")[n].alias(n) for n in names])


@query("lg4_parse_json", f"""WITH {LOGS}
SELECT event_id, 'mail u' || user_id || '@example.com' AS message, 'p' || k AS pod, CAST(k AS VARCHAR) AS tries FROM lg WHERE event_type = 'view'""")
def lg4(spark, sf_dir):
    return parsed(spark, sf_dir, "json").select("event_id", *[F.col("fields")[n].alias(n) for n in ("message", "pod", "tries")])


@query("lg4_parse_event_props", f"WITH {twins.EVENTS} SELECT event_id, CAST(k AS VARCHAR) AS k FROM ev")
def lg4b(spark, sf_dir):
    rows = twins.table(spark, sf_dir, "events")
    return rows.select("event_id", lg.parse_json(F.col("props"))["k"].alias("k"))


@query("lg5_parse_stacktrace", f"""WITH {LOGS}
SELECT event_id, 'com.acme.Svc' || k || 'Exception' AS exception, '2' AS frames, 3::BIGINT AS n_lines FROM lg WHERE event_type = 'click'""")
def lg5(spark, sf_dir):
    f = F.col("fields")
    return parsed(spark, sf_dir, "stacktrace").select(
        "event_id", f["exception"].alias("exception"), f["frames"].alias("frames"),
        F.size(F.split("value", "\n")).cast("long").alias("n_lines"))


def pii_texts(spark, sf_dir):
    """Whole documents, and one line per event with every kind of personal data."""
    docs = twins.table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text")
    digits = F.lpad((F.col("us") % 10_000_000_000).cast("string"), 10, "0")
    user = F.col("user_id").cast("string")
    cvv = F.lpad((F.col("k") + 100).cast("string"), 3, "0")
    line = F.concat(
        F.lit("u"), user, F.lit("@example.com call +91 "), digits, F.lit(" or +91"), digits, F.lit(","), digits, F.lit(";"), digits,
        F.lit(" pan ABCDE"), F.lpad(F.col("k").cast("string"), 4, "0"), F.lit("F id 12"), digits, F.lit(" CVV: "), cvv,
        F.lit(" ref 123"), digits)
    lines = twins.events(spark, sf_dir).select(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), line.alias("text"))
    return docs.unionByName(lines)


PII_TEXTS = twins.EVENTS + """,
pd AS (SELECT *, lpad(CAST(us % 10000000000 AS VARCHAR), 10, '0') AS dg FROM ev),
txt AS (
  SELECT 'd' || doc_id AS id, text FROM documents
  UNION ALL
  SELECT 'e' || event_id, 'u' || user_id || '@example.com call +91 ' || dg || ' or +91' || dg || ',' || dg || ';' || dg || ' pan ABCDE'
    || lpad(CAST(k AS VARCHAR), 4, '0') || 'F id 12' || dg || ' CVV: ' || lpad(CAST(k + 100 AS VARCHAR), 3, '0') || ' ref 123' || dg FROM pd
)"""
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def twice(text, pattern, token):
    """Boundaries are consumed here, so neighbours need a second pass."""
    once = f"regexp_replace({text}, '{pattern}', '{token}', 'g')"
    return f"regexp_replace({once}, '{pattern}', '{token}', 'g')"


MASKED_SQL = {
    "email": f"regexp_replace(text, '{_EMAIL}', '<EMAIL>', 'g')",
    "phone": twice("text", r"(^|[^0-9])(?:\+91[- ]?)?[0-9]{10}($|[^0-9])", r"\1<PHONE>\2"),
    "pan": "regexp_replace(text, '[A-Z]{5}[0-9]{4}[A-Z]', '<PAN>', 'g')",
    "aadhaar": twice("text", r"(^|[^0-9+])[0-9]{12}($|[^0-9])", r"\1<AADHAAR>\2"),
    "cvv": r"regexp_replace(text, '((?i:cvv2?)[^0-9*]{0,10})[0-9]{3,4}', '\1***', 'g')",
}


def _mask_query(number, kind):
    @query(f"lg{number}_mask_{kind}", f"""WITH {PII_TEXTS}, m AS (SELECT id, text, {MASKED_SQL[kind]} AS masked FROM txt)
SELECT id, md5(masked) AS digest, masked <> text AS changed FROM m""")
    def run(spark, sf_dir):
        rows = pii_texts(spark, sf_dir).select("id", "text", F.explode(F.array(tx.mask(F.col("text"), kind))).alias("masked"))
        return rows.select("id", F.md5("masked").alias("digest"), (F.col("masked") != F.col("text")).alias("changed"))

    return run


for _number, _kind in ((6, "email"), (7, "phone"), (8, "pan"), (9, "aadhaar"), (10, "cvv")):
    _mask_query(_number, _kind)


@query("lg11_normalise_log", f"""WITH {LOGS}
SELECT event_id, CASE WHEN event_type = 'click' OR event_type = 'purchase' THEN NULL ELSE ts END AS "timestamp",
  CASE WHEN event_type = 'signup' THEN 'ns1' END AS namespace,
  CASE WHEN event_type = 'view' THEN 'p' || k ELSE 'ship' || k END AS pod, service,
  CASE WHEN event_type IN ('click', 'view') THEN 'critical' WHEN event_type = 'signup' THEN 'warning' ELSE 'info' END AS severity,
  CASE event_type WHEN 'view' THEN 'mail <EMAIL>' WHEN 'signup' THEN 'user ' || user_id || ' said "hi"' END AS message,
  topic AS source_topic FROM lg WHERE event_type <> 'error' AND dept <> 'retail'""")
def lg11(spark, sf_dir):
    good, _ = lg.dispatch_parse(lg.department_filter(raw_logs(spark, sf_dir), DEPARTMENTS))
    rows = lg.normalise_log(good.withColumn("_event_id", F.col("event_id")), "given_cluster")
    short = F.when(F.col("source_topic").rlike("^(app|linkerd)"), F.col("message"))
    return rows.select(F.col("_event_id").alias("event_id"), ntz(F.col("timestamp")).alias("timestamp"), "namespace", "pod", "service",
                       F.when(F.col("severity") == "warning", "warning").otherwise(F.col("severity")).alias("severity"),
                       short.alias("message"), "source_topic")


@query("lg12_decode_cluster", f"""WITH {twins.EVENTS},
n AS (SELECT event_id, CASE user_id % 3 WHEN 0 THEN 'east-web-cluster-0' WHEN 1 THEN 'west-batch-cluster-0' ELSE 'lab-cluster-0' END || (k % 9) AS name FROM ev)
SELECT event_id, name, CASE WHEN starts_with(name, 'east-') THEN 'first' WHEN starts_with(name, 'west-') THEN 'second' END AS datacentre,
  CASE WHEN name LIKE '%web%' THEN 'web' WHEN name LIKE '%batch%' THEN 'batch' ELSE 'lab' END AS role,
  CAST(right(name, 1) AS INTEGER) AS number FROM n""")
def lg12(spark, sf_dir):
    stem = F.when(F.col("user_id") % 3 == 0, "east-web-cluster-0").when(F.col("user_id") % 3 == 1, "west-batch-cluster-0").otherwise("lab-cluster-0")
    rows = twins.events(spark, sf_dir).select("event_id", F.concat(stem, (F.col("k") % 9).cast("string")).alias("name"))
    return rows.select("event_id", "name", F.inline(F.array(tx.decode_cluster(F.col("name"), {"east": "first", "west": "second"}))))


@query("lg13_pii_audit", rf"""WITH {PII_TEXTS},
c AS (SELECT len(regexp_extract_all(text, '{_EMAIL}')) AS email, len(regexp_extract_all(text, '[A-Z]{{5}}[0-9]{{4}}[A-Z]')) AS pan,
  len(list_filter(regexp_extract_all(text, '\+?[0-9]+'), lambda x: regexp_full_match(x, '[0-9]{{12}}'))) AS aadhaar,
  len(list_filter(regexp_extract_all(text, '\+?[0-9]+'), lambda x: regexp_full_match(x, '(\+91)?[0-9]{{10}}|\+[0-9]{{10}}'))) AS phone,
  len(regexp_extract_all(text, '(?i:cvv2?)[^0-9*]{{0,10}}[0-9]{{3,4}}')) AS cvv FROM txt)
SELECT kind, CAST(sum(n) AS BIGINT) AS hits, 0::BIGINT AS "left" FROM c UNPIVOT (n FOR kind IN (email, pan, aadhaar, phone, cvv)) GROUP BY 1""")
def lg13(spark, sf_dir):
    return lg.pii_audit(pii_texts(spark, sf_dir), "text")


def lines(spark, sf_dir):
    docs = twins.table(spark, sf_dir, "documents")
    at = F.expr("timestamp'2024-01-01' + make_dt_interval(0, 0, cast(doc_id as int), 0)")
    return tm.split_lines(docs.select(F.col("source").alias("service"), at.alias("ts"), "text"), "text")


def _masked_sql(column):
    for pattern in tx.VARIABLES:
        column = f"regexp_replace({column}, '{pattern}', '<*>', 'g')"
    return column


_BLANK = r"'[ \t\r\n\f]+', ' ', 'g'"
LINES = rf"""
ln0 AS (SELECT source AS service, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS ts, unnest(string_split(text, chr(10))) AS line FROM documents),
ln AS (SELECT *, row_number() OVER () AS id, string_split(trim(regexp_replace({_masked_sql('line')}, {_BLANK})), ' ') AS tokens
       FROM ln0 WHERE trim(regexp_replace(line, {_BLANK})) <> '')"""
TEMPLATES = LINES + """,
lb AS (SELECT *, len(tokens) AS n_tokens, coalesce(list_filter(tokens, lambda t: t <> '<*>')[1], '') AS head FROM ln),
tk AS (SELECT id, service, ts, n_tokens, head, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS pos FROM lb),
hole AS (SELECT service, n_tokens, head, pos, count(DISTINCT word) > 8 AS hole FROM tk GROUP BY ALL),
tp AS (SELECT id, service, ts, string_agg(CASE WHEN hole THEN '<*>' ELSE word END, ' ' ORDER BY pos) AS template
       FROM tk JOIN hole USING (service, n_tokens, head, pos) GROUP BY 1, 2, 3)"""


@query("tm1_tokenise", f"""WITH {LINES}
SELECT service, md5(array_to_string(tokens, ' ')) AS digest, CAST(len(tokens) AS BIGINT) AS n_tokens, count(*) AS n FROM ln GROUP BY ALL""")
def tm1(spark, sf_dir):
    rows = lines(spark, sf_dir).select("service", tx.tokenise(F.col("line")).alias("tokens")).groupBy("service", "tokens").agg(
        F.count(F.lit(1)).alias("n"))
    return rows.select("service", F.md5(F.array_join("tokens", " ")).alias("digest"), F.size("tokens").cast("long").alias("n_tokens"), "n")


@query("tm2_mine_templates", f"""WITH {TEMPLATES}
SELECT service, md5(template) AS digest, count(*) AS n, min(ts) AS first_seen, max(ts) AS last_seen FROM tp GROUP BY 1, 2""")
def tm2(spark, sf_dir):
    rows = tm.mine_templates(lines(spark, sf_dir))
    return rows.select("service", F.md5("template").alias("digest"), "n", ntz(F.col("first_seen")).alias("first_seen"),
                       ntz(F.col("last_seen")).alias("last_seen"))


@query("tm3_template_counts", f"""WITH {TEMPLATES}
SELECT date_trunc('hour', ts) AS window_start, service, md5(template) AS digest, count(*) AS n FROM tp GROUP BY 1, 2, 3""")
def tm3(spark, sf_dir):
    rows = tm.template_counts(lines(spark, sf_dir))
    return rows.select(ntz(F.col("window_start")).alias("window_start"), "service", F.md5("template").alias("digest"), "n")


@query("tm4_template_deltas", f"""WITH {TEMPLATES},
d AS (SELECT service, template, count(*) FILTER (ts < TIMESTAMP '2024-01-01 06:00:00') AS count_before,
        count(*) FILTER (ts >= TIMESTAMP '2024-01-01 06:00:00') AS count_after FROM tp GROUP BY 1, 2),
r AS (SELECT *, (count_after + 1.0::DOUBLE) / (count_before + 1.0::DOUBLE) AS ratio FROM d)
SELECT service, md5(template) AS digest, count_before, count_after, count_before = 0 AS is_new, round(ratio, 6) AS ratio
FROM r WHERE count_before = 0 OR ratio >= 2 OR ratio <= 0.5""")
def tm4(spark, sf_dir):
    rows = tm.template_deltas(lines(spark, sf_dir), F.lit("2024-01-01 06:00:00").cast("timestamp"))
    return rows.select("service", F.md5("template").alias("digest"), "count_before", "count_after", "is_new", F.round("ratio", 6).alias("ratio"))


def source_changes(spark, sf_dir):
    """Orders as changes of the document sources, spread over the log's first days."""
    orders = twins.table(spark, sf_dir, "orders")
    return orders.select(
        F.concat(F.lit("src"), (F.col("o_custkey") % 20).cast("string")).alias("service"),
        (F.lit(1_704_067_200_000_000) + (F.col("o_orderkey") % 1000) * 600_000_000).alias("change_us"),
        F.col("o_orderkey").alias("change_id"))


@query("tm5_new_templates", f"""WITH {TEMPLATES},
seen AS (SELECT service, template, epoch_us(min(ts)) AS first_us FROM tp GROUP BY 1, 2),
ch AS (SELECT 'src' || (o_custkey % 20) AS service, 1704067200000000 + (o_orderkey % 1000) * 600000000 AS change_us, max(o_orderkey) AS change_id
       FROM orders GROUP BY 1, 2)
SELECT seen.service, md5(template) AS digest, first_us, change_us, change_id
FROM seen ASOF LEFT JOIN ch ON seen.service = ch.service AND seen.first_us >= ch.change_us""")
def tm5(spark, sf_dir):
    rows = tm.new_templates(lines(spark, sf_dir), source_changes(spark, sf_dir))
    return rows.select("service", F.md5("template").alias("digest"), "first_us", "change_us", "change_id")


@query("tm6_example_fields", rf"""WITH {TEMPLATES},
mn AS (SELECT service, template, line FROM ln JOIN tp USING (id, service)),
ex AS (SELECT service, template, unnest(string_split(trim(regexp_replace(line, {_BLANK})), ' ')) AS raw,
        unnest(string_split(template, ' ')) AS shown, generate_subscripts(string_split(template, ' '), 1) - 1 AS pos FROM mn)
SELECT service, md5(template) AS digest, CAST(pos AS INTEGER) AS pos, min(raw) AS value FROM ex WHERE contains(shown, '<*>') GROUP BY ALL""")
def tm6(spark, sf_dir):
    rows = tm.example_fields(lines(spark, sf_dir))
    return rows.select("service", F.md5("template").alias("digest"), F.explode("fields").alias("pos", "value"))


@query("ag5_compression_ratio", f"""WITH {TEMPLATES}
SELECT service, count(*) AS lines, count(DISTINCT template) AS templates, round(count(*) / count(DISTINCT template)::DOUBLE, 6) AS ratio
FROM tp GROUP BY 1""")
def ag5(spark, sf_dir):
    return tm.compression_ratio(lines(spark, sf_dir)).withColumn("ratio", F.round("ratio", 6))


@query("snk5_write_parsed_logs", f"""WITH {LOGS}
SELECT service, CAST(ts AS DATE) AS date, count(*) AS n FROM lg WHERE event_type IN ('signup', 'view') AND dept <> 'retail' GROUP BY 1, 2""")
def snk5(spark, sf_dir):
    good, _ = lg.dispatch_parse(lg.department_filter(raw_logs(spark, sf_dir), DEPARTMENTS))
    path = run_dir(spark, "parsed-logs")
    write_parsed_log_files(lg.normalise_log(good, "given_cluster").filter("timestamp IS NOT NULL"), path)
    return spark.read.parquet(path).groupBy("service", "date").agg(F.count(F.lit(1)).alias("n"))


@query("ag8_k8s_timeline", f"""WITH {twins.EVENTS}
SELECT service AS workload, event_id, event_type AS reason,
  row_number() OVER (PARTITION BY service ORDER BY us, event_id) AS position FROM ev WHERE event_type <> 'view'""")
def ag8(spark, sf_dir):
    from faultlens.operators.incidents import k8s_timeline

    return k8s_timeline(k8s_events(spark, sf_dir), ["workload"], "ts", ["event_id"]).select("workload", "event_id", "reason", "position")
