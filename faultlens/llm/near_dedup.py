"""Near-duplicate documents by bottom-k sketches of one hash function.

Each document keeps the ``sketch`` smallest hashes of its word shingles.  Inverted lists of
retained values generate candidates, the sketch of the union estimates their similarity,
and the full shingle sets decide.

A retained value that more than ``common`` documents share is common.  Every document is
listed under its ``listed`` smallest uncommon values, twice as many if three in ten of its
values are common.  Two documents at the threshold share each listed value with the
probability of their similarity, so a pair is overlooked with about 0.15 ** 12 (similarity
0.85), for texts that are half common wording with 0.3 ** 24.  Documents at least half of
whose values are common are also compared by their full sets, see ``_crowded``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultlens.llm import textops as T
from faultlens.llm.components import across, components, placed, stars
from faultlens.llm.store import Tables, pick

SKETCH, LISTED, COMMON = 48, 12, 16
BROADCAST_IDS = 1_000_000  #: ids sent to every executor at most (8 MB); beyond, they are shuffled


def _sets(column: pa.Array, width: int):
    """Sorted distinct shingle hashes of each text."""
    for lo, hi, raw, offsets in T.slices(column):
        w = T.words(raw, offsets, T.SPACED)
        grams = T.ngrams(w.hash, width)
        for i in range(hi - lo):
            a, b = int(w.bounds[i]), int(w.bounds[i + 1])
            if b - a >= width:
                yield np.unique(T.signed(grams[a:b - width + 1]))
            elif b > a:
                yield T.signed(T.ngrams(w.hash[a:b], b - a))
            else:
                yield np.zeros(0, np.int64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64()))


def sketches(docs: DataFrame, width: int, sketch: int = SKETCH) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, sketch) of each row; fp1 and fp2 identify the whole set."""
    def run(batches):
        T.hold()
        for batch in batches:
            n, f, g, s = [], [], [], []
            for x in _sets(batch.column(1), width):
                u = x.view(np.uint64)
                n.append(len(x))
                f.append(u.sum(dtype=np.uint64))
                g.append(T.mix(u ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64))
                s.append(x[:sketch])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(np.array(f, np.uint64).view(np.int64)),
                 pa.array(np.array(g, np.uint64).view(np.int64)), _lists(s)], ["doc_id", "n_shingles", "fp1", "fp2", "sketch"])

    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id long, n_shingles long, fp1 long, fp2 long, sketch array<long>")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        T.hold()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(list(_sets(part.column(1), width)))], ["doc_id", "grams"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, grams array<long>")


def _linked(docs, one, width, percent, sketch, listed, common, tables) -> DataFrame:
    """(node, component) of the representatives in ``one`` (node, size, sketch)."""
    t = percent / 100
    none = F.array().cast("array<long>")
    value = one.select("node", F.explode("sketch").alias("key"))
    often = tables.keep(value.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > common).select("key"))
    hot = value.join(often, "key").groupBy("node").agg(F.collect_set("key").alias("hot"))  # at most `sketch` values
    split = tables.keep(one.join(hot, "node", "left").withColumn("hot", F.coalesce("hot", none)).withColumn("mostly", F.size("hot") * 2 >= F.size("sketch")))
    rare = F.array_except("sketch", "hot")
    rare = split.select("node", "size", F.explode(F.slice(rare, F.lit(1), F.when(F.size("hot") * 10 >= F.size("sketch") * 3, 2 * listed).otherwise(listed))).alias("key"))
    crowd = split.where("mostly").select("node", "size", F.explode(F.slice(F.array_sort("hot"), 1, listed)).alias("key"))
    sizes = lambda u, v: (u("size") >= v("size") * t) & (v("size") >= u("size") * t)

    def estimated(pairs, least):
        sk = one.select("node", "sketch")
        joined = pairs.join(sk.toDF("u", "su"), "u").join(sk.toDF("v", "sv"), "v")
        union = F.slice(F.array_sort(F.array_union("su", "sv")), 1, sketch)
        both = F.size(F.array_intersect(F.array_intersect("su", "sv"), union))
        return joined.select("u", "v", (both / F.size(union)).alias("weight")).where(F.col("weight") >= least)

    def sets_of(ids):
        small = ids.count() <= BROADCAST_IDS
        text = pick(docs, "doc_id", "text").join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
        return tables.keep(shingle_sets(text, width).toDF("node", "grams"))

    def compared(pairs):
        pairs = tables.keep(pairs)
        ids = tables.keep(pairs.select(F.col("u").alias("doc_id")).unionByName(pairs.select(F.col("v").alias("doc_id"))).distinct())
        sets = sets_of(ids)
        both = pairs.join(sets.toDF("u", "gu"), "u").join(sets.toDF("v", "gv"), "v").withColumn("inter", F.size(F.array_intersect("gu", "gv")))
        return both.withColumn("link", F.col("inter") * 100 >= (F.size("gu") + F.size("gv") - F.col("inter")) * percent)

    def links(pairs):
        return compared(pairs).where("link").select("u", "v")

    least = max(0.0, t - 5 * (t * (1 - t) / sketch) ** 0.5)
    live, star = stars(rare, tables)
    best = lambda pairs: pairs.groupBy("v").agg(F.max(F.struct("weight", "u")).alias("b")).select(F.col("b.u").alias("u"), "v")
    crowds, hubs = stars(crowd, tables)
    hubs = tables.keep(estimated(hubs, 0.5))
    fame = hubs.groupBy("u").agg(F.count("*").alias("fame"))
    chosen = hubs.join(fame, "u").groupBy("v").agg(F.max(F.struct("fame", "u")).alias("b")).select(F.col("b.u").alias("u"), "v")
    first = compared(best(estimated(star, least)).withColumn("hub", F.lit(False)).unionByName(chosen.withColumn("hub", F.lit(True))))
    first = tables.keep(first.select("u", "v", "hub", "link", "inter", F.when(F.col("hub"), F.array_except("gv", "gu")).alias("rest")))
    edges = first.where("link").select("u", "v")
    known = components(edges, tables)
    edges = tables.keep(edges.unionByName(links(estimated(across(live, known, tables, sizes), least).select("u", "v"))))
    known = tables.keep(components(edges, tables))
    more = _crowded(split, first, known, t, sizes, sets_of, tables)
    return components(edges.unionByName(links(estimated(more, least).select("u", "v"))), tables)


def _crowded(split, first, known, t, sizes, sets_of, tables) -> DataFrame:
    """Candidate pairs among documents of mostly common wording.

    Let h be the hub of both x and y.  If they share a shingle outside h, the lists of those
    shingles hold the pair.  If not, what they share lies in h, so both must share
    t / (1 + t) * (|x| + |y|) shingles with h, which leaves few sizes for y.  Pairs with
    different hubs, or none, meet in the lists of the rarest shingles: two sets at
    similarity t share one of the |x| - ceil(t * |x|) + 1 rarest of each.
    """
    share = t / (1 + t)
    mine = split.where("mostly").select("node", "size")
    hubbed = first.where("hub").select(F.col("v").alias("node"), F.col("u").alias("hub"), "inter", "rest").unionByName(
        first.where("hub").select(F.col("u").alias("node"), F.col("u").alias("hub")).distinct().join(split.select("node", F.col("size").alias("inter")), "node")
        .select("node", "hub", "inter", F.array().cast("array<long>").alias("rest")))
    here = tables.keep(placed(mine.join(hubbed, "node", "left"), known))

    def need(u, v):
        return share * (u("size") + v("size")) - 1e-9

    outside = here.select("node", "size", "hub", "inter", F.size("rest").alias("more"), F.explode("rest").alias("g")).withColumn("key", F.xxhash64("hub", "g"))
    outside = across(outside.drop("hub", "g"), known, tables, lambda u, v: sizes(u, v) & (
        F.least(u("inter"), v("inter")) + F.least(u("more"), v("more")) >= need(u, v)))

    x = here.where("hub is not null and size > 0")
    top = F.floor(F.col("inter") / share - F.col("size") + 1e-6).cast("long")
    low = F.ceil(F.col("size") * t - 1e-6).cast("long")
    top = F.least(top, F.floor(F.col("size") / t + 1e-6).cast("long"))
    home = here.where("node = hub").select("hub", F.col("component").alias("home"))
    far = x.join(home.distinct(), "hub").where("component <> home")
    far = far.where(low <= top).select(F.col("node").alias("u"), F.col("component").alias("cu"), "hub", F.explode(F.sequence(low, top)).alias("size"), F.col("size").alias("nu"))
    inside = far.join(x.select(F.col("node").alias("v"), F.col("component").alias("cv"), "hub", "size", "inter"), ["hub", "size"])
    inside = inside.where((F.col("cu") != F.col("cv")) & (F.col("inter") >= share * (F.col("nu") + F.col("size")) - 1e-9)).select("u", "v").distinct()

    grams = sets_of(tables.keep(mine.select(F.col("node").alias("doc_id"))))
    each = grams.select("node", F.explode("grams").alias("g"))
    count = each.groupBy("g").agg(F.count("*").alias("n")).where("n > 1")
    order = each.join(count, "g", "left").groupBy("node").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "g"))).alias("o"))  # one set
    prefix = order.select("node", F.explode(F.slice("o", F.lit(1), (F.size("o") - F.ceil(F.size("o") * t - 1e-6) + 1).cast("int"))).alias("x"))
    listed = prefix.where("x.n > 1").select("node", F.col("x.g").alias("key")).join(here.select("node", "size", "hub"), "node")
    apart = across(listed, known, tables, lambda u, v: sizes(u, v) & ~F.coalesce(u("hub") == v("hub"), F.lit(False)))
    return outside.unionByName(inside).unionByName(apart).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, sketch: int = SKETCH, listed: int = LISTED, common: int = COMMON) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Links documents with 100 * |A & B| >= percent * |A | B| over distinct ``width``-word
    shingles; a text with fewer words is one shingle, one without words links with nothing.
    component_id is the smallest doc_id reachable.  Null text counts as empty.  Rows that
    share a doc_id are one node, linked if any of their texts is; each keeps its own row.
    A null doc_id is in no group (component_id null) and kept.  An empty table gives none.
    """
    spark = docs.sparkSession
    tables = Tables(spark, "near")
    base = tables.keep(sketches(docs, width, sketch))
    real = base.where("doc_id is not null and n_shingles > 0")
    heads = real.groupBy("n_shingles", "fp1", "fp2").agg(F.min("doc_id").alias("node"))
    member = real.select("doc_id", "n_shingles", "fp1", "fp2").join(heads, ["n_shingles", "fp1", "fp2"])
    key = heads.select(F.col("node").alias("doc_id"), "n_shingles", "fp1", "fp2")
    one = tables.keep(real.join(key, ["doc_id", "n_shingles", "fp1", "fp2"], "left_semi")
                      .select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("size"), "sketch"))

    linked = _linked(docs, one, width, percent, sketch, listed, common, tables)
    joined = member.select("doc_id", "node").distinct().join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    reached = tables.keep(joined.groupBy("doc_id").agg(F.min("component").alias("component_id"), F.max("component").alias("other")))
    if reached.where("component_id <> other").limit(1).count():  # an id with several texts joins their groups
        known = components(joined.select(F.col("doc_id").alias("u"), F.col("component").alias("v")), tables)
        reached = reached.join(known, F.col("node") == F.col("doc_id"), "left").select("doc_id", F.coalesce("component", "doc_id").alias("component_id"))
    out = base.join(reached.select("doc_id", "component_id"), "doc_id", "left")
    group = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", group.alias("component_id"), F.coalesce(F.col("doc_id") == group, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, **more) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id; columns are unchanged.

    Rows with a null doc_id stay.  Rows that share the doc_id that stays all stay.
    """
    lost = near_duplicates(docs, width, percent, **more).where("not kept").select(F.col("doc_id").alias("_lost_id")).distinct()
    return docs.join(lost, docs["doc_id"] == lost["_lost_id"], "left_anti")
