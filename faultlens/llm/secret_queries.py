"""Secrets of all documents."""

from pyspark.sql import functions as F

from faultlens.llm.registry import query, read
from faultlens.llm.secrets import scan


@query("op5_secrets")
def op5_secrets(spark, sf_dir):
    """The secrets of every document as counts, digest and spans; null and empty texts hold none."""
    found = scan(read(spark, sf_dir, "documents"))
    order = F.create_map(*[F.lit(x) for x in ("assign", 0, "access", 1, "hex", 2)])

    def joined(spans):
        placed = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.coalesce(order[x["kind"]], F.lit(3)).alias("o"), x["kind"].alias("kind"), x["end"].alias("end"))))
        return F.array_join(F.transform(placed, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def n(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "found")).alias("spans"))
