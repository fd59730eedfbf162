"""Connected groups from inverted lists, without forming all pairs of a list.

First every node of a list is compared with one hub of that list (``stars``).  Lists that
then hold several groups are paired across groups only (``across``), so a list of n copies
costs n comparisons and still no link between different groups is missed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faultlens.llm.store import Tables


def _mark(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """(node, component) of every node of (u, v): the smallest node it reaches.

    Alternates two star steps; minima are combined before the shuffle, so a node with a
    third of all edges is one row per task there.
    """
    now = tables.keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen = _mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        new = tables.keep(small.where("u <> v").distinct())
        mark = _mark(new)
        tables.drop(now)
        now = new
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def stars(lists: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Lists of two nodes or more with their hub, and the distinct pairs (hub u, node v)."""
    hubs = lists.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    live = tables.keep(lists.join(hubs, "key"))
    return live, live.where("hub <> node").select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct()


def placed(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """Nodes with their component; a node without links is its own."""
    return nodes.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))


def across(live: DataFrame, known: DataFrame, tables: Tables, fits=None) -> DataFrame:
    """Distinct pairs (u, v) of one list and different components for which ``fits`` holds.

    ``fits`` gets each side's column by name, as in ``fits(u, v)`` with ``u("size")``.
    """
    here = placed(live, known)
    mixed = here.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    open_ = tables.keep(here.join(mixed, "key"))
    rest = [c for c in open_.columns if c not in ("key", "node")]
    a = open_.select("key", F.col("node").alias("u"), *[F.col(c).alias(f"u_{c}") for c in rest])
    b = open_.select("key", F.col("node").alias("v"), *[F.col(c).alias(f"v_{c}") for c in rest])
    ok = F.col("u_component") < F.col("v_component")
    if fits is not None:
        ok &= fits(lambda c: F.col(f"u_{c}"), lambda c: F.col(f"v_{c}"))
    return a.join(b, "key").where(ok).select("u", "v").distinct()
