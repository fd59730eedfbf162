"""The test tables in the role of operational data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultlens.functions.columns import micros


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a zoned time, integer microseconds, the number in ``props`` and a service."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        micros(F.col("ts")).alias("us"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.concat(F.lit("svc"), (F.col("user_id") % 10).cast("string")).alias("service"),
        F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")).alias("cluster"),
    )


# The same columns in SQL.
EVENTS = """
ev AS (
  SELECT event_id, ts, epoch_us(ts) AS us, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         'svc' || (user_id % 10) AS service, 'c' || (user_id % 3) AS cluster
  FROM events
)"""


def anomalies(ev: DataFrame) -> DataFrame:
    """Errors as anomalies."""
    return ev.filter("event_type = 'error'").select(
        F.col("event_id").alias("anomaly_id"), "cluster", "service",
        F.concat(F.lit("sig"), (F.col("k") % 4).cast("string")).alias("signature"), F.col("us").alias("a_us"))


def candidates(ev: DataFrame) -> DataFrame:
    """Signups as deploys and purchases as config edits."""
    return ev.filter("event_type IN ('signup', 'purchase')").select(
        F.col("event_id").alias("cand_id"), "cluster", "service",
        F.when(F.col("event_type") == "signup", "deploy").otherwise("config_change").alias("kind"),
        F.col("us").alias("c_us"))


def feedback(ev: DataFrame) -> DataFrame:
    """Views and clicks as past judgements of deploys and config edits."""
    return ev.filter("event_type IN ('view', 'click')").select(
        F.concat(F.lit("sig"), (F.col("k") % 4).cast("string")).alias("signature"),
        F.when(F.col("event_type") == "view", "deploy").otherwise("config_change").alias("kind"),
        (F.col("value") > 50).alias("correct"))


def ring(ev: DataFrame) -> DataFrame:
    """Each service depends on the next one."""
    return ev.select((F.col("user_id") % 10).alias("s")).distinct().select(
        F.concat(F.lit("svc"), F.col("s").cast("string")).alias("src"),
        F.concat(F.lit("svc"), ((F.col("s") + 1) % 10).cast("string")).alias("dst"))


INCIDENT_PARTS = EVENTS + """,
anom AS (
  SELECT event_id AS anomaly_id, cluster, service, 'sig' || (k % 4) AS signature, us AS a_us, user_id
  FROM ev WHERE event_type = 'error'
),
cand AS (
  SELECT event_id AS cand_id, cluster, service, us AS c_us, user_id,
         CASE WHEN event_type = 'signup' THEN 'deploy' ELSE 'config_change' END AS kind
  FROM ev WHERE event_type IN ('signup', 'purchase')
),
hist AS (
  SELECT 'sig' || (k % 4) AS signature,
         CASE WHEN event_type = 'view' THEN 'deploy' ELSE 'config_change' END AS kind,
         CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS BIGINT) AS ok, count(*) AS n
  FROM ev WHERE event_type IN ('view', 'click') GROUP BY 1, 2
),
present AS (SELECT DISTINCT user_id % 10 AS s FROM ev),
edge AS (SELECT 'svc' || s AS src, 'svc' || ((s + 1) % 10) AS dst FROM present),
hop1 AS (SELECT src AS a, dst AS b FROM edge),
hop2 AS (SELECT x.src AS a, y.dst AS b FROM edge x JOIN edge y ON x.dst = y.src),
down AS (
  SELECT a, b, min(d) AS d FROM (
    SELECT 'svc' || s AS a, 'svc' || s AS b, 0 AS d FROM present
    UNION ALL SELECT a, b, 1 FROM hop1 UNION ALL SELECT a, b, 2 FROM hop2) GROUP BY 1, 2
),
dist AS (
  SELECT coalesce(x.a, y.b) AS service, coalesce(x.b, y.a) AS cause_service, x.d AS down, y.d AS up
  FROM down x FULL OUTER JOIN down y ON x.a = y.b AND x.b = y.a
),
pairs AS (
  SELECT a.*, c.cand_id, c.kind, c.service AS cause_service, c.c_us
  FROM anom a JOIN cand c ON a.cluster = c.cluster
   AND c.c_us BETWEEN a.a_us - 1800000000 AND a.a_us + 300000000
),
scored AS (
  SELECT p.*, exp(-abs(c_us - a_us) / 600000000.0::DOUBLE) AS ft,
         coalesce(greatest(1.0::DOUBLE / (1.0::DOUBLE + down), 0.5::DOUBLE / (1.0::DOUBLE + up)), 0.0::DOUBLE) AS fp,
         (coalesce(ok, 0) + 1.0::DOUBLE) / (coalesce(n, 0) + 2.0::DOUBLE) AS fh,
         CASE WHEN p.kind = 'deploy' THEN 1.0::DOUBLE ELSE 0.6::DOUBLE END AS fk
  FROM pairs p LEFT JOIN dist d ON d.service = p.service AND d.cause_service = p.cause_service
       LEFT JOIN hist h ON h.signature = p.signature AND h.kind = p.kind
),
ranked AS (
  SELECT *, round(raw, 6) AS score, CAST(rn AS INTEGER) AS "rank" FROM (
    SELECT *, row_number() OVER (PARTITION BY anomaly_id ORDER BY raw DESC, abs(c_us - a_us), cand_id) AS rn FROM (
      SELECT *, 0.4::DOUBLE * ft + 0.3::DOUBLE * fp + 0.2::DOUBLE * fh + 0.1::DOUBLE * fk AS raw FROM scored))
  WHERE rn <= 5
)"""


def distances(ev: DataFrame, hops: int = 2) -> DataFrame:
    from faultlens.operators import topology

    return topology.distances(ring(ev), ev.select("service"), hops)


def ranked_causes(ev: DataFrame) -> DataFrame:
    from faultlens.operators import correlate

    return correlate.rank_causes(anomalies(ev), candidates(ev), distances(ev), correlate.history(feedback(ev)))
