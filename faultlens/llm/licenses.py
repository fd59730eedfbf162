"""License scan by diagonal voting.

Every rolling pair of words of every text is joined with the places of that pair in the
templates.  A match at word i of the text and word j of a template votes for the diagonal
i - j.  Neighbouring diagonals of one template are merged, and spans with enough votes are
verified on the words themselves: phrases word by word, longer templates by edit distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from faultlens.llm import textops as T
from faultlens.llm.editdist import best_stretch
from faultlens.llm.store import Tables, pick

K = 2
LIKENESS = 0.7  #: share of a template's words that survive the edit distance
MOST_TEMPLATES = 50_000  #: templates of a table that every executor gets
BROADCAST_ROWS = 500_000  #: documents with candidate spans sent to every executor at most

# Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Opening words of common licenses and of the notices that point to them.
TEMPLATES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", "mit"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache-2.0"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under the mit license", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license", "apache-2.0"),
    ("this document is in the public domain", "public-domain"),
)


def edits(words):
    """Edits that a template of so many words may have; a column or a number."""
    return words - (-(-words * round(LIKENESS * 100) // 100)) if isinstance(words, int) else F.floor(words * (100 - round(LIKENESS * 100)) / 100)


def least_votes(words):
    """Pairs of words that are left of a template after as many edits: each spoils K of its ``words - K + 1`` at most."""
    left = words - K + 1 - K * edits(words)
    return max(1, left) if isinstance(words, int) else F.greatest(F.lit(1), left)


def word_hashes(texts: list[str]) -> T.Words:
    raw, offsets = T.buffers(pa.array(texts, pa.large_string()))
    return T.words(raw, offsets, T.ALNUM)


def template_places(spark, entries) -> DataFrame:
    """(g, template, place, words): the place of each pair of words in each template; their number is that of the fixed texts."""
    w, rows = word_hashes([t for t, _ in entries]), []
    for i in range(len(entries)):
        h = w.hash[w.bounds[i]:w.bounds[i + 1]]
        rows += [(int(g), i, k, len(h)) for k, g in enumerate(T.signed(T.ngrams(h, K)))]
    return spark.createDataFrame(rows, "g long, template int, place int, words int")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return pick(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1 << 63)).alias("d"), F.xxhash64(text).alias("t"), text.alias("text"))


def _pairs(keyed: DataFrame) -> DataFrame:
    """(d, t, at, g): every rolling pair of words of every text."""
    def run(batches):
        for batch in batches:
            for lo, hi, raw, offsets in T.slices(batch.column(2)):
                w = T.words(raw, offsets, T.ALNUM)
                g = T.ngrams(w.hash, K)
                n = np.maximum(np.diff(w.bounds) - K + 1, 0)
                ok = w.row[:len(g)] == w.row[K - 1:] if len(g) else np.zeros(0, bool)
                ends = np.concatenate([[0], np.cumsum(n)])
                grams = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(T.signed(g[ok])))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), grams], ["d", "t", "grams"])

    return keyed.mapInArrow(run, "d long, t long, grams array<long>").select("d", "t", F.posexplode("grams").alias("at", "g"))


def find(docs: DataFrame, entries=None, tables: Tables | None = None) -> DataFrame:
    """(d, t, template, first, last, score) of every verified span; d and t are a row's id and the hash of its text.

    Entries are (text, label, exact).  An exact entry is found wherever its words stand one
    after another; another where LIKENESS of its words survive the edit distance.  Each of
    the edits that leaves shifts the diagonal by one at most and spoils K pairs, so diagonals no farther
    apart are merged and spans with the votes still left are verified: none that would pass is lost.
    """
    spark = docs.sparkSession
    tables = tables or Tables(spark, "licenses")
    entries = entries or catalogue()
    places = template_places(spark, [(e[0], e[1]) for e in entries])
    keyed = _keyed(docs)
    votes = _pairs(keyed).join(F.broadcast(places), "g").select("d", "t", "template", "words", (F.col("at") - F.col("place")).alias("diagonal"), "place")
    exact = F.array(*[F.lit(bool(e[2])) for e in entries])
    lines = votes.groupBy("d", "t", "template", "words", "diagonal").agg(F.countDistinct("place").alias("votes")).withColumn("exact", F.element_at(exact, F.col("template") + 1))
    whole = lines.where(F.col("exact") & (F.col("votes") == F.col("words") - K + 1))
    part = Window.partitionBy("d", "t", "template").orderBy("diagonal")
    new = F.when(F.col("diagonal") - F.lag("diagonal").over(part) <= F.greatest(F.lit(1), edits(F.col("words"))), 0).otherwise(1)
    loose = lines.where("not exact").withColumn("new", new).withColumn("island", F.sum("new").over(part))
    merged = loose.groupBy("d", "t", "template", "words", "island").agg(F.sum("votes").alias("votes"), F.min("diagonal").alias("diagonal"), F.max("diagonal").alias("high"))
    merged = merged.where(F.col("votes") >= least_votes(F.col("words")))
    spans = whole.select("d", "t", "template", "diagonal", F.col("diagonal").alias("high")).unionByName(merged.select("d", "t", "template", "diagonal", "high"))
    wanted = tables.keep(spans.groupBy("d", "t").agg(F.collect_list(F.struct("template", "diagonal", "high")).alias("spans")))
    small = wanted.count() <= BROADCAST_ROWS
    texts = keyed.join(F.broadcast(wanted) if small else wanted, ["d", "t"]).select("d", "t", "text", "spans").dropDuplicates(["d", "t"])
    known = word_hashes([e[0] for e in entries])
    patterns = [known.hash[known.bounds[i]:known.bounds[i + 1]].tolist() for i in range(len(entries))]
    sure = [bool(e[2]) for e in entries]

    def verify(batches):
        for batch in batches:
            out = []
            for k, spans in enumerate(batch.column(3).to_pylist()):
                raw, offsets = T.buffers(batch.column(2).slice(k, 1))
                h = T.words(raw, offsets, T.ALNUM).hash.tolist()
                for s in spans:
                    p, lo, hi = patterns[s["template"]], s["diagonal"], s["high"]
                    if sure[s["template"]]:
                        if h[lo:lo + len(p)] == p:
                            out.append((k, s["template"], lo, lo + len(p) - 1, 1.0))
                        continue
                    first = max(0, lo - edits(len(p)))
                    dist, a, z = best_stretch(p, h[first:hi + len(p) + edits(len(p))])
                    score = 1 - dist / len(p)
                    if score >= LIKENESS:
                        out.append((k, s["template"], first + a, first + z, score))
            if out:
                at, template, a, z, score = zip(*out)
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(template, pa.int32()), pa.array(a, pa.int64()), pa.array(z, pa.int64()), pa.array(score, pa.float64())],
                    ["d", "t", "template", "first", "last", "score"])

    return texts.mapInArrow(verify, "d long, t long, template int, first long, last long, score double")


def catalogue():
    return [(t, label, True) for t, label in PHRASES] + [(t, label, False) for t, label in TEMPLATES]


def entries_of(templates: DataFrame) -> list[tuple[str, str, bool]]:
    """The rows (text, label) of a table as templates, besides the base phrases; MOST_TEMPLATES at most."""
    rows = pick(templates, "text", "label").dropna().distinct().limit(MOST_TEMPLATES + 1).collect()
    if len(rows) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    return [(t, label, True) for t, label in PHRASES] + sorted((r.text, r.label, False) for r in rows if len(word_hashes([r.text]).hash) >= K)


def scan(docs: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row.

    ``templates (text, label)`` replace the own ones; those of under two words are left out.
    A null or empty text has no words and no labels.  Equal rows get equal results.
    """
    entries = entries_of(templates) if templates is not None else catalogue()
    spans = find(docs, entries)
    label = F.array(*[F.lit(e[1]) for e in entries])
    exact = F.array(*[F.lit(e[2]) for e in entries])
    marked = spans.withColumn("label", F.element_at(label, F.col("template") + 1)).withColumn("base", F.element_at(exact, F.col("template") + 1))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  at most as many as there are labels
    found = marked.groupBy("d", "t").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined("label").alias("labels"), F.max("score").alias("score"))

    def count(batches):
        for batch in batches:
            for lo, hi, raw, offsets in T.slices(batch.column(3)):
                n = np.diff(T.words(raw, offsets, T.ALNUM).bounds)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(3)), pa.array(n.astype(np.int64))], ["doc_id", "d", "t", "n_words"])

    keyed = _keyed(docs).select(F.when(F.col("d") > F.lit(-1 << 63), F.col("d")).alias("doc_id"), "d", "t", "text")
    words = keyed.mapInArrow(count, "doc_id long, d long, t long, n_words long")
    none = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return words.join(found, ["d", "t"], "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word", none("base_labels"), none("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
