"""Periodic runs of all documents."""

from pyspark.sql import functions as F

from faultlens.llm.periodic import periodic_runs
from faultlens.llm.registry import query, read


def planted(docs):
    """The documents, every tenth by the hash of its id made periodic from one of its words on; a null id stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def changed(w):
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.get(w, F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int"))), " ")

    # One pass over a list that holds the words: they are split once, and only where the hash asks for it.
    again = F.element_at(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, changed(w)).otherwise(F.lit(""))), 1)
    return docs.select("doc_id", F.when(h % 10 == 0, again).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    """Every document with its runs as digests and the run that repeats most."""
    found = periodic_runs(planted(read(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))))
    more = F.aggregate("runs", F.expr("cast(null as struct<start: bigint, length: bigint, period: bigint>)"), lambda best, x: F.when(
        best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best))
    rows = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"].cast("string"), x["length"].cast("string"), x["period"].cast("string")), F.lit("\n")))
    out = found.withColumn("best", more)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(rows, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
