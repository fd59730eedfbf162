"""Log templates: lines that differ only in variable parts become one row.

A fixed-depth parse tree in one pass depends on the order of the lines.  Here the
same idea runs as grouped passes that do not: lines meet in a bucket of equal
service, length and leading word, and a position with many different words in its
bucket becomes a hole.  Lines are reduced to distinct ones before anything else,
which is where the volume goes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultlens.functions.columns import SECOND, bucket, micros
from faultlens.functions.text import HOLE, raw_tokens, tokenise
from faultlens.session import materialise

MAX_WORDS = 8
SMALL_BYTES = 32_000_000  #: buckets that are broadcast, so that the lines stay where they are
BUCKET = ["service", "n_tokens", "head"]


def split_lines(texts: DataFrame, text: str) -> DataFrame:
    """One row per non-blank line of a text."""
    lines = texts.withColumn("line", F.explode(F.split(text, "\n"))).drop(text)
    return lines.filter(F.trim(F.regexp_replace("line", r"[ \t\r\n\f]+", " ")) != "")


def distinct_lines(logs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Masked lines per service with count, first and last time and one original."""
    return (
        logs.select("service", "ts", "line", *by, tokenise(F.col("line")).alias("tokens"))
        .groupBy("service", "tokens", *by)
        .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
             F.min("line").alias("example"))
        .withColumns(_bucketed())
    )


def _bucketed() -> dict[str, Column]:
    """What tells a line's bucket beside its service."""
    return {"n_tokens": F.size("tokens"), "head": F.coalesce(F.get(F.filter("tokens", lambda t: t != HOLE), F.lit(0)), F.lit(""))}


def _join_bucket(lines: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Join on the bucket; lines without a service share one like others.

    The other side is stored and measured first: the lines are shuffled only if it is large.
    """
    other = materialise(other, "buckets")
    held = F.length("head") + F.coalesce(F.length("service"), F.lit(0)) + (F.size("holes") if "holes" in other.columns else 0) + 32
    if (other.agg(F.sum(held.cast("long"))).first()[0] or 0) <= SMALL_BYTES:
        other = F.broadcast(other)
    named = other.select(*[F.col(c).alias(f"_b_{c}") for c in BUCKET], *[c for c in other.columns if c not in BUCKET])
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in BUCKET])
    return lines.join(named, on, how).drop(*[f"_b_{c}" for c in BUCKET])


def hole_positions(lines: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """Per bucket, an array saying which positions are holes.

    A bucket of ``max_words`` lines or fewer cannot have a hole, so only the words of
    larger ones are laid out.
    """
    crowded = lines.groupBy(*BUCKET).count().filter(F.col("count") > max_words).select(*BUCKET)
    words = _join_bucket(lines, crowded, "left_semi").select(*BUCKET, F.posexplode("tokens").alias("pos", "word")).distinct()
    spots = words.groupBy(*BUCKET, "pos").agg((F.count(F.lit(1)) > max_words).alias("hole"))
    # One entry per token position, hence no longer than a line.
    return spots.groupBy(*BUCKET).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "hole"))), lambda s: s["hole"]).alias("holes"))


def templated(logs: DataFrame, by: Sequence[str] = (), max_words: int = MAX_WORDS) -> DataFrame:
    """Distinct masked lines with their template; logs ``(service, ts, line, by...)``."""
    return with_templates(materialise(distinct_lines(logs, by).drop("example"), "lines"), max_words)


def with_templates(lines: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """Templates of distinct lines that are already at hand."""
    return _filled(lines, _holed(lines, max_words))


def _holed(lines: DataFrame, max_words: int) -> DataFrame:
    """Buckets that have holes; the lines of others stay as they are."""
    return hole_positions(lines, max_words).filter(F.exists("holes", lambda h: h))


def _filled(lines: DataFrame, holes: DataFrame) -> DataFrame:
    marked = _join_bucket(lines, holes, "left")
    filled = F.zip_with("tokens", "holes", lambda t, hole: F.when(hole, HOLE).otherwise(t))
    shown = F.when(F.col("holes").isNull(), F.col("tokens")).otherwise(filled)
    return marked.withColumn("template", F.array_join(shown, " ")).drop("head")


def merge_lines(parts: DataFrame) -> DataFrame:
    """Distinct lines of several runs as one set."""
    return parts.groupBy("service", "tokens", "n_tokens", "head").agg(
        F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.min("example").alias("example"))


def mine_templates(logs: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    return fold_templates(templated(logs, (), max_words))


def fold_templates(rows: DataFrame) -> DataFrame:
    """Counts and times per template; merges partial results of several runs too."""
    return rows.groupBy("service", "template").agg(
        F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))


def template_counts(logs: DataFrame, window: str = "1 hour", max_words: int = MAX_WORDS) -> DataFrame:
    windowed = logs.withColumn("window_start", F.window("ts", window)["start"])
    return templated(windowed, ["window_start"], max_words).groupBy("window_start", "service", "template").agg(
        F.sum("n").alias("n"))


def template_deltas(logs: DataFrame, onset: Column, factor: float = 2.0, max_words: int = MAX_WORDS) -> DataFrame:
    """Templates that are new after the onset or whose count changed by ``factor`` (smoothed by one)."""
    sided = logs.withColumn("after", F.col("ts") >= onset)
    rows = templated(sided, ["after"], max_words).groupBy("service", "template").agg(
        F.sum(F.when(~F.col("after"), F.col("n")).otherwise(0)).alias("count_before"),
        F.sum(F.when(F.col("after"), F.col("n")).otherwise(0)).alias("count_after"))
    ratio = (F.col("count_after") + 1.0) / (F.col("count_before") + 1.0)
    rows = rows.withColumn("is_new", F.col("count_before") == 0).withColumn("ratio", ratio)
    return rows.filter(F.col("is_new") | (ratio >= factor) | (ratio <= 1.0 / factor))


def onset_shifts(logs: DataFrame, incidents: DataFrame, before_s: int, after_s: int, slot_s: int = 60,
                 factor: float = 2.0, max_words: int = MAX_WORDS, carried: DataFrame | None = None, onto: DataFrame | None = None) -> DataFrame:
    """Templates of an incident's service that are new or changed by ``factor`` at its own onset.

    incidents ``(incident, service, onset_us)``; logs ``(service, ts, line)``; ``carried``
    holds further columns per ``(service, template)``.  A template's counts per slot meet the
    onsets of its service in blocks of time, each onset once for all incidents of its slot, so
    that pairs are formed where they are counted and are not shuffled.  Asked are only templates with a
    line in the window.  The slot that holds the onset counts as after it.  Of several onsets of
    one incident in one service the latest counts.

    ``onto (incident, ...)`` asks for these rows instead, each with ``shifts``: the array of its
    incident's ``(service, template, count_before, count_after, carried...)``, sharpest first.
    The rows then go to the blocks, so that no list is shuffled.
    """
    slot, before, after = slot_s * SECOND, before_s * SECOND, after_s * SECOND
    block = max((before + after) // 2, slot)
    timed = logs.filter(F.col("service").isNotNull()).withColumn("slot_us", bucket(micros(F.col("ts")), slot) * slot)
    counts = templated(timed, ["slot_us"], max_words).groupBy("service", "template", "slot_us").agg(F.sum("n").alias("n"))
    reach = F.sequence(bucket(F.col("slot_us") - after + 1, block), bucket(F.col("slot_us") + before, block))
    told = counts.select("service", "template", F.explode(reach).alias("_block"), F.struct("slot_us", "n").alias("_at"))
    # No longer than a block and its window have slots.
    told = told.groupBy("service", "template", "_block").agg(F.collect_list("_at").alias("_slots"))
    added = [c for c in carried.columns if c not in ("service", "template")] if carried is not None else []
    if added:
        told = told.join(carried, ["service", "template"], "left")
    told = materialise(told, "slots")

    edge = (bucket(F.col("onset_us"), slot) * slot).alias("_edge")
    asked = incidents.select("incident", "service", edge).filter("service IS NOT NULL AND _edge IS NOT NULL")
    asked = materialise(asked.groupBy("incident", "service").agg(F.collect_set("_edge").alias("_edges")), "onsets")

    def lines(slots: Column, lo: Column, hi: Column) -> Column:
        return F.aggregate(slots, F.lit(0).cast("long"), lambda n, s: n + F.when((s["slot_us"] >= lo) & (s["slot_us"] < hi), s["n"]).otherwise(0))

    def ratio(n_before: Column, n_after: Column) -> Column:
        return (n_after + 1.0) / (n_before + 1.0)

    def changed(n_before: Column, n_after: Column) -> Column:
        return (n_before == 0) | (ratio(n_before, n_after) >= factor) | (ratio(n_before, n_after) <= 1.0 / factor)

    sides = F.col("count_before"), F.col("count_after")
    result = ["incident", "service", "template", "count_before", "count_after", *added]

    def counted(which: DataFrame) -> DataFrame:
        onsets = which.select(F.struct("incident").alias("_who"), "service", F.explode("_edges").alias("_edge")).groupBy("service", "_edge").agg(
            F.collect_list("_who").alias("_who")).withColumn("_block", bucket(F.col("_edge"), block))
        pairs = told.join(onsets, ["service", "_block"]).select(
            "service", "template", *added, "_edge", "_who",
            lines(F.col("_slots"), F.col("_edge") - before, F.col("_edge")).alias("count_before"),
            lines(F.col("_slots"), F.col("_edge"), F.col("_edge") + after).alias("count_after"))
        return pairs.filter("count_before + count_after > 0")

    def by_incident(which: DataFrame) -> DataFrame:
        # Filtered before the incidents of a slot are told apart.
        rows = counted(which.filter(F.size("_edges") == 1)).filter(changed(*sides)).withColumn("_who", F.explode("_who")).select("*", "_who.*").select(*result)
        again = which.filter(F.size("_edges") > 1)
        if again.limit(1).count():
            latest = counted(again).withColumn("_who", F.explode("_who")).groupBy("_who", "service", "template").agg(
                F.max_by(F.struct("count_before", "count_after", *added), "_edge").alias("_last"))
            rows = rows.unionByName(latest.select("_who.*", "service", "template", "_last.*").filter(changed(*sides)).select(*result))
        return rows

    if onto is None:
        return by_incident(asked).withColumn("is_new", F.col("count_before") == 0).withColumn("ratio", ratio(*sides))

    def sharpness(n_before: Column, n_after: Column) -> Column:
        return F.round(F.abs(F.log(ratio(n_before, n_after))), 9)

    onsets = asked.groupBy("incident").agg(
        F.sum(F.size("_edges")).alias("_n"), F.first("service").alias("_service"), F.first(F.get("_edges", F.lit(0))).alias("_edge"))
    onsets = materialise(onsets.filter("incident IS NOT NULL"), "onsets")
    several = onsets.filter("_n > 1").select("incident")
    rows = onto.join(onsets.filter("_n = 1").drop("_n"), "incident", "left").withColumn("_block", bucket(F.col("_edge"), block))
    # What an incident is told of a service is one array in the end; a block's is not much longer.
    blocks = told.groupBy(F.col("service").alias("_service"), "_block").agg(F.collect_list(F.struct("template", "_slots", *added)).alias("_told"))
    found = F.transform("_told", lambda t, i: F.struct(
        lines(t["_slots"], F.col("_edge") - before, F.col("_edge")).alias("b"), lines(t["_slots"], F.col("_edge"), F.col("_edge") + after).alias("a"),
        t["template"].alias("template"), i.alias("i")))
    found = F.filter(found, lambda c: (c["b"] + c["a"] > 0) & changed(c["b"], c["a"]))
    found = F.sort_array(F.transform(found, lambda c: F.struct((-sharpness(c["b"], c["a"])).alias("less"), c["template"].alias("template"), c["b"].alias("b"), c["a"].alias("a"), c["i"].alias("i"))))
    entries = F.transform(found, lambda c: F.struct(
        F.col("_service").alias("service"), c["template"].alias("template"), c["b"].alias("count_before"), c["a"].alias("count_after"),
        *[F.get(F.col("_told"), c["i"])[n].alias(n) for n in added]))
    rows = rows.join(blocks, ["_service", "_block"], "left").withColumn("shifts", entries).drop("_service", "_edge", "_block", "_told")
    if not several.limit(1).count():
        return rows
    entry = F.struct((-sharpness(*sides)).alias("less"), "service", "template", F.struct(*result[1:]).alias("entry"))

    def first(x: Column, y: Column) -> Column:  # maps cannot be compared, so the entries themselves are not
        x, y = (F.struct(z["less"], z["service"], z["template"]) for z in (x, y))
        return F.when(x < y, -1).when(x > y, 1).otherwise(0)

    lists = by_incident(asked.join(several, "incident")).groupBy("incident").agg(F.array_sort(F.collect_list(entry), first).alias("_several"))
    rows = rows.join(lists, "incident", "left")
    return rows.withColumn("shifts", F.coalesce(F.transform("_several", lambda c: c["entry"]), "shifts")).drop("_several")


def new_templates(logs: DataFrame, changes: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """First sight of each template with the latest change of its service before it."""
    from faultlens.operators.joins import after_deploy

    seen = mine_templates(logs, max_words).withColumn("first_us", micros(F.col("first_seen")))
    return after_deploy(seen.select("service", "template", "first_us"), changes)


def masked_values(logs: DataFrame) -> DataFrame:
    """Per distinct masked line and masked position, the smallest original value of all its lines."""
    split = logs.select("service", tokenise(F.col("line")).alias("tokens"), raw_tokens(F.col("line")).alias("raw"))
    masked = split.filter(F.exists("tokens", lambda t: t.contains(HOLE)))
    word = F.posexplode(F.arrays_zip("tokens", "raw")).alias("pos", "w")
    spots = masked.select("service", "tokens", word).filter(F.col("w.tokens").contains(HOLE))
    return spots.groupBy("service", "tokens", "pos").agg(F.min("w.raw").alias("value")).withColumns(_bucketed())


def example_fields(logs: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """Per template and hole, the smallest original value seen there on any line.

    Where a distinct line is not masked its word is the original; where it is, every line is looked at.
    """
    lines = materialise(distinct_lines(logs).drop("example"), "lines")
    holes = materialise(_holed(lines, max_words), "holes")
    word = F.posexplode(F.arrays_zip(F.col("tokens").alias("raw"), F.split("template", " ").alias("shown"))).alias("pos", "w")
    plain = _filled(lines, holes).select("service", "template", word)
    plain = plain.filter(F.col("w.shown").contains(HOLE) & ~F.col("w.raw").contains(HOLE))
    masked = _filled(masked_values(logs), holes).select("service", "template", "pos", "value")
    spots = masked.unionByName(plain.select("service", "template", "pos", F.col("w.raw").alias("value")))
    best = spots.groupBy("service", "template", "pos").agg(F.min("value").alias("value"))
    return best.groupBy("service", "template").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("pos", "value")))).alias("fields"))


def compression_ratio(logs: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    rows = mine_templates(logs, max_words)
    return rows.groupBy("service").agg(
        F.sum("n").alias("lines"), F.count(F.lit(1)).alias("templates"),
        (F.sum("n") / F.count(F.lit(1))).alias("ratio"))
