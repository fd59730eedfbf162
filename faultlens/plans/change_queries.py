"""Change events and diffs built from orders and parts."""

from pyspark.sql import functions as F

from faultlens.functions.columns import ntz
from faultlens.operators import changes as ch
from faultlens.plans import twins
from faultlens.plans.registry import query
from faultlens.sources.records import read_change_webhooks

SOURCES = ["ArgoCD", "cloudbuild", "atlantis", "github", "jenkins"]


def webhooks(spark, sf_dir):
    """One webhook body per order, in the form of its source; every fifth source is unknown."""
    o = twins.table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    at = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = F.concat(F.lit("svc"), (F.col("o_custkey") % 10).cast("string"))
    sha, actor = F.concat(F.lit("sha"), key.cast("string")), F.concat(F.lit("u"), F.col("o_custkey").cast("string"))
    undo = F.when(F.col("o_orderstatus") == "F", F.struct(F.lit(1).alias("id")))
    argocd = F.struct(
        F.struct(
            F.struct(name.alias("name")).alias("metadata"),
            F.struct(F.struct(F.lit("ns").alias("namespace"), F.lit("c1").alias("name")).alias("destination"),
                     F.struct(F.lit("repo").alias("repoURL")).alias("source")).alias("spec"),
            F.struct(
                F.struct(at.alias("finishedAt"), F.struct(
                    F.struct(actor.alias("username")).alias("initiatedBy"), undo.alias("rollback")).alias("operation")).alias("operationState"),
                F.struct(sha.alias("revision")).alias("sync")).alias("status"),
        ).alias("app"))
    build = F.struct(at.alias("finishTime"), F.struct(
        actor.alias("_ACTOR"), name.alias("_SERVICE"), F.lit("ns").alias("_NAMESPACE"), sha.alias("COMMIT_SHA")).alias("substitutions"))
    plan = F.struct(
        at.alias("timestamp"), F.struct(actor.alias("username")).alias("user"), F.struct(name.alias("name")).alias("project"),
        F.struct((key % 1000).alias("num"), sha.alias("head_commit")).alias("pull"), F.lit("c1").alias("workspace"))
    push = F.struct(
        F.struct(at.alias("timestamp")).alias("head_commit"), F.struct(actor.alias("login")).alias("sender"),
        F.struct(name.alias("name"), F.lit("org/repo").alias("full_name")).alias("repository"), sha.alias("after"))
    n = key % 5
    body = F.when(n == 0, F.to_json(argocd)).when(n == 1, F.to_json(build)).when(n == 2, F.to_json(plan)).otherwise(F.to_json(push))
    source = F.element_at(F.array(*[F.lit(x) for x in SOURCES]), (n + 1).cast("int"))
    return o.select("o_orderkey", source.alias("source"), body.alias("value"))


WEBHOOKS = """
wh AS (SELECT o_orderkey, o_orderkey % 5 AS n, o_orderdate AS ts, 'svc' || (o_custkey % 10) AS name, 'sha' || o_orderkey AS sha, 'u' || o_custkey AS actor,
  o_orderstatus FROM orders)"""


@query("src6_read_change_webhooks", f"""WITH {WEBHOOKS}
SELECT CASE n WHEN 0 THEN 'argocd' WHEN 1 THEN 'cloudbuild' WHEN 2 THEN 'atlantis' WHEN 3 THEN 'github' ELSE 'jenkins' END AS source, count(*) AS n
FROM wh GROUP BY 1""")
def src6(spark, sf_dir):
    return read_change_webhooks(webhooks(spark, sf_dir)).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("chg1_normalise_changes", f"""WITH {WEBHOOKS}
SELECT o_orderkey, CASE n WHEN 0 THEN CASE WHEN o_orderstatus = 'F' THEN 'rollback' ELSE 'deploy' END WHEN 1 THEN 'deploy' WHEN 2 THEN 'tf_apply'
  ELSE 'config_change' END AS event_type, ts, actor, name, sha, CASE WHEN n = 2 THEN CAST(o_orderkey % 1000 AS INTEGER) END AS pr
FROM wh WHERE n < 4
UNION ALL SELECT o_orderkey, 'rejected', NULL, NULL, NULL, NULL, NULL FROM wh WHERE n = 4""")
def chg1(spark, sf_dir):
    good, bad = ch.normalise_changes(read_change_webhooks(webhooks(spark, sf_dir)))
    rows = good.select("o_orderkey", "event_type", ntz(F.col("ts")).alias("ts"), "actor", F.col("target.name").alias("name"),
                       F.col("git.sha").alias("sha"), F.col("git.pr").alias("pr"))
    return rows.unionByName(bad.select("o_orderkey", F.lit("rejected").alias("event_type")), allowMissingColumns=True)


@query("chg2_plan_diff", """WITH p AS (SELECT p_partkey, CAST(p_size AS VARCHAR) AS size, CAST(p_size + p_partkey % 2 AS VARCHAR) AS size2, p_brand FROM part)
SELECT p_partkey, 'res.p' || p_partkey AS address, 'size' AS path, size AS old, size2 AS new FROM p WHERE size <> size2
UNION ALL SELECT p_partkey, 'res.p' || p_partkey, 'legacy', p_brand, NULL FROM p
UNION ALL SELECT p_partkey, 'res.p' || p_partkey, 'tier', NULL, 'x' FROM p WHERE p_partkey % 3 = 0""")
def chg2(spark, sf_dir):
    p = twins.table(spark, sf_dir, "part")
    before = F.struct("p_brand", F.col("p_size").alias("size"), F.col("p_brand").alias("legacy"))
    after = F.struct("p_brand", (F.col("p_size") + F.col("p_partkey") % 2).alias("size"), F.when(F.col("p_partkey") % 3 == 0, "x").alias("tier"))
    change = F.struct(F.array(F.lit("update")).alias("actions"), before.alias("before"), after.alias("after"))
    one = F.struct(F.concat(F.lit("res.p"), F.col("p_partkey").cast("string")).alias("address"), F.col("p_type").alias("type"),
                   F.col("p_name").alias("name"), change.alias("change"))
    plans = p.select("p_partkey", F.to_json(F.struct(F.array(one).alias("resource_changes"))).alias("value"))
    return ch.plan_diff(plans).select("p_partkey", "address", "path", "old", "new")


def manifest(spark, sf_dir, replicas, port, extra, image_port, quoted):
    p = twins.table(spark, sf_dir, "part")
    doc = F.struct(
        F.col("p_name").alias("name"),
        F.struct(replicas.alias("replicas"), F.col("p_brand").alias("image"), F.array(F.lit(80), port).alias("ports")).alias("spec"),
        F.when(extra, F.struct(F.lit("v").alias("k"))).alias("extra"))
    # A leaf ten levels down below a dotted key, text that looks like JSON, and a number that turns into its text.
    deep = F.struct(image_port.cast("string").alias("app.io/port"))
    for step in ("ref", "from", "env", "containers", "spec", "template", "tier", "set", "kind"):
        deep = F.struct(deep.alias(step))
    text = F.to_json(F.struct(doc.alias("doc"), deep.alias("deep"), F.lit('{"z":1}').alias("note")))
    flag = F.when(quoted, F.lit(',"flag":"1"}')).otherwise(F.lit(',"flag":1}'))
    return p.select("p_partkey", F.concat(F.substr(text, F.lit(1), F.length(text) - 1), flag).alias("doc"))


def versions(spark, sf_dir):
    key, size = F.col("p_partkey"), F.col("p_size")
    never = F.lit(False)
    return (manifest(spark, sf_dir, size, size, never, size, never),
            manifest(spark, sf_dir, F.when(key % 4 == 0, size + 1).otherwise(size), F.when(key % 5 == 0, F.lit(443)).otherwise(size), key % 6 == 0,
                     F.when(key % 8 == 0, size + 1).otherwise(size), key % 9 == 0),
            manifest(spark, sf_dir, F.when(key % 3 == 0, size + 1).otherwise(size), F.when(key % 7 == 0, F.lit(8080)).otherwise(size), never, size, never))


def _leaves(df):
    return ch.leaves(df, ["p_partkey"], "doc")


DEEP = r"deep.kind.set.tier.template.spec.containers.env.from.ref.app\.io/port"
DIFF = f"""
df AS (
  SELECT p_partkey, 'doc.spec.replicas' AS path, CAST(p_size AS VARCHAR) AS old, CAST(p_size + 1 AS VARCHAR) AS new, 'number' AS old_kind, 'number' AS new_kind FROM part WHERE p_partkey % 4 = 0
  UNION ALL SELECT p_partkey, 'doc.spec.ports[1]', CAST(p_size AS VARCHAR), '443', 'number', 'number' FROM part WHERE p_partkey % 5 = 0
  UNION ALL SELECT p_partkey, 'doc.extra.k', NULL, 'v', NULL, 'string' FROM part WHERE p_partkey % 6 = 0
  UNION ALL SELECT p_partkey, '{DEEP}', CAST(p_size AS VARCHAR), CAST(p_size + 1 AS VARCHAR), 'string', 'string' FROM part WHERE p_partkey % 8 = 0
  UNION ALL SELECT p_partkey, 'flag', '1', '1', 'number', 'string' FROM part WHERE p_partkey % 9 = 0
)"""


@query("chg3_manifest_diff", f"WITH {DIFF} SELECT * FROM df")
def chg3(spark, sf_dir):
    old, new, _ = versions(spark, sf_dir)
    return ch.manifest_diff(_leaves(old), _leaves(new), ["p_partkey"])


@query("chg4_three_way_diff", f"""WITH v AS (
  SELECT p_partkey, 'doc.spec.replicas' AS path, CAST(p_size AS VARCHAR) AS last_applied,
    CAST(CASE WHEN p_partkey % 4 = 0 THEN p_size + 1 ELSE p_size END AS VARCHAR) AS live,
    CAST(CASE WHEN p_partkey % 3 = 0 THEN p_size + 1 ELSE p_size END AS VARCHAR) AS desired FROM part
  UNION ALL SELECT p_partkey, 'doc.spec.ports[1]', CAST(p_size AS VARCHAR),
    CASE WHEN p_partkey % 5 = 0 THEN '443' ELSE CAST(p_size AS VARCHAR) END,
    CASE WHEN p_partkey % 7 = 0 THEN '8080' ELSE CAST(p_size AS VARCHAR) END FROM part
  UNION ALL SELECT p_partkey, 'doc.extra.k', NULL, 'v', NULL FROM part WHERE p_partkey % 6 = 0
  UNION ALL SELECT p_partkey, '{DEEP}', CAST(p_size AS VARCHAR), CAST(p_size + 1 AS VARCHAR), CAST(p_size AS VARCHAR) FROM part WHERE p_partkey % 8 = 0),
o AS (SELECT *, last_applied IS DISTINCT FROM live AS d, last_applied IS DISTINCT FROM desired AS w FROM v)
SELECT p_partkey, path, last_applied, live, desired, CASE WHEN d AND w THEN CASE WHEN live IS DISTINCT FROM desired THEN 'conflict' ELSE 'converged' END
  WHEN d THEN 'drift' ELSE 'change' END AS outcome FROM o WHERE d OR w
UNION ALL SELECT p_partkey, 'flag', '1', '1', '1', 'drift' FROM part WHERE p_partkey % 9 = 0""")
def chg4(spark, sf_dir):
    applied, live, desired = (_leaves(x) for x in versions(spark, sf_dir))
    return ch.three_way_diff(applied, live, desired, ["p_partkey"])


@query("chg5_diff_summary", f"""WITH {DIFF}
SELECT p_partkey, 'Deployment part' || p_partkey || ': ' || string_agg(path || ' ' || coalesce(old, '∅') || ' → ' || coalesce(new, '∅'), '; ' ORDER BY path) AS diff_summary
FROM df GROUP BY p_partkey""")
def chg5(spark, sf_dir):
    old, new, _ = versions(spark, sf_dir)
    diffs = ch.manifest_diff(_leaves(old), _leaves(new), ["p_partkey"])
    name = F.concat(F.lit("part"), F.col("p_partkey").cast("string"))
    return ch.diff_summary(diffs, ["p_partkey"], F.lit("Deployment"), name)
