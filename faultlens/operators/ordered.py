"""Ordered-data building blocks that never put a whole key into one task.

A plain ``Window.partitionBy(key)`` sorts every row of a key in one task, which
fails once a single key holds a large share of the table.  The helpers below cut
each key's timeline into chunks:

* bounded frames copy the rows near the edge of a chunk of time into the
  neighbouring chunk (``halo_chunks``), so each chunk can be windowed on its own;
* unbounded running values are computed inside chunks of equally many rows
  (``balanced``) and then shifted by a carry taken from one summary row per chunk
  (``running``), however the rows are spread over keys and time;
* chains, where a row decides which later one counts, follow pointers inside such
  chunks and then go on with the few rows at which a chunk is entered (``spaced``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlens.functions.columns import SECOND, bucket
from faultlens.session import materialise

HOUR = 3600 * SECOND
CHUNK_ROWS = 500_000  #: narrow rows that one task follows pointers through


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def halo_chunks(
    df: DataFrame, us: str, chunk_us: int, before_us: int = 0, after_us: int = 0
) -> DataFrame:
    """Add ``_chunk`` and ``_own``; a row appears in every chunk whose frames reach it.

    A frame of ``[t - before, t + after]`` around any row owned by a chunk is then
    complete inside that chunk.  Keep ``_own`` rows after windowing.
    """
    first = bucket(F.col(us) - after_us, chunk_us)
    last = bucket(F.col(us) + before_us, chunk_us)
    return df.withColumn("_chunk", F.explode(F.sequence(first, last))).withColumn(
        "_own", F.col("_chunk") == bucket(F.col(us), chunk_us)
    )


def framed(
    df: DataFrame,
    keys: Sequence[str],
    us: str,
    columns: dict[str, Column],
    before_us: int,
    after_us: int = 0,
    chunk_us: int | None = None,
) -> DataFrame:
    """Aggregates over ``[t - before, t + after]`` of each key, both ends included."""
    chunk_us = chunk_us or max(before_us + after_us, HOUR)
    frame = (
        W.partitionBy(*keys, "_chunk").orderBy(us).rangeBetween(-before_us, after_us)
    )
    out = halo_chunks(df, us, chunk_us, before_us, after_us)
    out = out.select("*", *[c.over(frame).alias(n) for n, c in columns.items()])
    return out.filter("_own").drop("_chunk", "_own")


def previous_within(
    df: DataFrame, keys: Sequence[str], us: str, order: Sequence[str], values: dict[str, str],
    within_us: int, chunk_us: int | None = None,
) -> DataFrame:
    """``lag`` of some columns, NULL when the previous row is ``within_us`` or more away."""
    chunk_us = chunk_us or max(within_us, HOUR)
    w = W.partitionBy(*keys, "_chunk").orderBy(us, *order)
    out = halo_chunks(df, us, chunk_us, within_us)
    near = F.col(us) - F.lag(us).over(w) < within_us
    out = out.select("*", *[F.when(near, F.lag(c).over(w)).alias(n) for n, c in values.items()])
    return out.filter("_own").drop("_chunk", "_own")


def balanced(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "_chunk", rows: int | None = None) -> DataFrame:
    """The rows, stored, with the number of their range of ``(keys, order)``.

    Ranges hold about equally many rows, so a key or a minute with most of the table is cut
    into many; rows that agree in all of ``keys`` and ``order`` share one.  There are as many
    as shuffle partitions, or one for every ``rows`` rows.
    """
    by = [F.col(c) for c in (*keys, *order)]
    cut = df.repartitionByRange(*by) if rows is None else df.repartitionByRange(max(1, ceil(df.count() / rows)), *by)
    return materialise(cut.withColumn(name, F.spark_partition_id()), "ranges")


def running(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str | Column],
    columns: dict[str, tuple[str, Column]],
    inclusive: bool = True,
) -> DataFrame:
    """Running sum, max or last non-null value per key over the whole history.

    ``chunk`` must not decrease along ``order``; ``balanced`` numbers chunks that way.
    Only one summary row per chunk is sorted per key; the rows themselves are sorted
    inside their own chunk.
    """
    frame = W.partitionBy(*keys, chunk).orderBy(*order)
    frame = frame.rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    earlier = W.partitionBy(*keys).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)

    def over(kind: str, value: Column) -> Column:
        return {"sum": F.sum, "max": F.max, "last": lambda v: F.last(v, ignorenulls=True)}[kind](value)

    local = df.select("*", *[over(k, v).over(frame).alias(f"_l_{n}") for n, (k, v) in columns.items()])

    totals = []
    for name, (kind, value) in columns.items():
        if kind == "last":
            rank = F.when(value.isNotNull(), F.struct(*[_bare(o) for o in order]))
            totals.append(F.max_by(value, rank).alias(f"_t_{name}"))
        else:
            totals.append(over(kind, value).alias(f"_t_{name}"))
    carry = df.groupBy(*keys, chunk).agg(*totals)
    carry = carry.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, chunk])],
        *[over(k, F.col(f"_t_{n}")).over(earlier).alias(f"_c_{n}") for n, (k, _) in columns.items()],
    )
    pairs = [(k, f"_k{i}") for i, k in enumerate([*keys, chunk])]
    joined = local.join(carry, _null_safe(local, carry, pairs), "left")

    result = []
    for name, (kind, _) in columns.items():
        here, before = F.col(f"_l_{name}"), F.col(f"_c_{name}")
        if kind == "sum":
            merged = F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
        elif kind == "max":
            merged = F.greatest(here, before)
        else:
            merged = F.coalesce(here, before)
        result.append(merged.alias(name))
    return joined.select(*df.columns, *result)


def _bare(o: str | Column) -> Column:
    return F.col(o) if isinstance(o, str) else o


def numbered(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], name: str
) -> DataFrame:
    """``row_number`` over a key of any size."""
    return running(df, keys, chunk, order, {name: ("sum", F.lit(1).cast("long"))})


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_us: str,
    right_us: str,
    carried: Sequence[str],
) -> DataFrame:
    """For each left row the newest right row of its key at or before it (left outer).

    Right rows sharing key and time are told apart by the largest ``carried`` values.
    A NULL key matches nothing, as in SQL.
    """
    right = right.dropna(subset=list(keys))
    newest = F.struct(*[F.col(c) for c in carried])
    marks = (
        right.groupBy(*keys, F.col(right_us).alias("_us"))
        .agg(F.max(newest).alias("_right"))
        .withColumn("_left", F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType))
        .withColumn("_side", F.lit(0))
    )
    asks = left.select(
        *keys,
        F.col(left_us).alias("_us"),
        F.lit(None).cast(marks.schema["_right"].dataType).alias("_right"),
        F.struct(*left.columns).alias("_left"),
        F.lit(1).alias("_side"),
    )
    both = balanced(asks.unionByName(marks), keys, ["_us", "_side"])
    out = running(both, keys, "_chunk", ["_us", "_side"], {"_found": ("last", F.col("_right"))})
    return out.filter("_side = 1").select("_left.*", *[f"_found.{c}" for c in carried])


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_us: str,
    right_us: str,
    before_us: int,
    after_us: int,
    bucket_us: int | None = None,
) -> DataFrame:
    """Pairs with equal keys and ``left - before <= right <= left + after``.

    Narrow buckets turn the range test into an equi-join; the left side is copied
    once per bucket its window touches (about eight), the right side stays single.
    """
    bucket_us = bucket_us or max((before_us + after_us) // 8, SECOND)
    lo = bucket(F.col(left_us) - before_us, bucket_us)
    hi = bucket(F.col(left_us) + after_us, bucket_us)
    l = left.withColumn("_b", F.explode(F.sequence(lo, hi)))
    r = right.withColumn("_rb", bucket(F.col(right_us), bucket_us))
    on = (F.col("_b") == F.col("_rb")) & F.col(right_us).between(
        F.col(left_us) - before_us, F.col(left_us) + after_us
    )
    for a, b in keys:
        on = on & (l[a] == r[b])
    return l.join(r, on).drop("_b", "_rb")


def nearest_in_window(
    requests: DataFrame,
    candidates: DataFrame,
    keys: Sequence[str],
    k: int,
    before_us: int,
    after_us: int,
) -> DataFrame:
    """The candidates of a key that can be among the k closest to each request time.

    ``requests(keys, r_us, payload...)`` and ``candidates(keys, c_us, c_id)`` give rows
    ``(keys, r_us, payload, c_us, c_id)``; requests must be distinct.  Among candidates of one key closeness decides, so
    only the k distinct times on either side of the request matter, and of equal
    times only the k smallest ids.  Everything else provably loses, hence the
    output has at most ``2·k·k`` rows per request however dense the window is, and
    no pair outside it is ever formed.  Positions come from running counts.
    """
    same_time = W.partitionBy(*keys, "c_us").orderBy("c_id")
    spots = (
        candidates.select(*keys, "c_us", "c_id")
        .withColumn("_n", F.row_number().over(same_time))
        .filter(F.col("_n") <= k)
        .groupBy(*keys, "c_us")
        .agg(F.sort_array(F.collect_list("c_id")).alias("_ids"))
    )
    payload = [c for c in requests.columns if c not in (*keys, "r_us")]
    asks = requests.withColumn("_p", F.struct("r_us", *payload))
    # Three marks per request: window start (exclusive side), the request, window end.
    marks = asks.select(
        *keys,
        "_p",
        F.explode(
            F.array(
                F.struct((F.col("r_us") - before_us).alias("us"), F.lit(0).alias("side")),
                F.struct(F.col("r_us").alias("us"), F.lit(2).alias("side")),
                F.struct((F.col("r_us") + after_us).alias("us"), F.lit(3).alias("side")),
            )
        ).alias("_m"),
    ).select(*keys, F.col("_m.us").alias("_us"), F.col("_m.side").alias("_side"), "_p",
             F.lit(None).cast(spots.schema["_ids"].dataType).alias("_ids"))
    both = marks.unionByName(
        spots.select(*keys, F.col("c_us").alias("_us"), F.lit(1).alias("_side"),
                     F.lit(None).cast(asks.schema["_p"].dataType).alias("_p"), "_ids")
    )
    both = balanced(both, keys, ["_us", "_side"])
    hit = F.when(F.col("_side") == 1, F.lit(1)).otherwise(F.lit(0)).cast("long")
    counted = materialise(running(both, keys, "_chunk", ["_us", "_side"], {"_pos": ("sum", hit)}), "positions")

    def at(side: int) -> Column:
        return F.max(F.when(F.col("_side") == side, F.col("_pos")))

    ranges = (
        counted.filter("_side <> 1")
        .groupBy(*keys, "_p")
        .agg(at(0).alias("_before"), at(2).alias("_here"), at(3).alias("_end"))
        .withColumn("_lo", F.greatest(F.col("_before") + 1, F.col("_here") - (k - 1)))
        .withColumn("_hi", F.least(F.col("_end"), F.col("_here") + k))
        .filter("_lo <= _hi")
        .select(*keys, "_p", F.explode(F.sequence("_lo", "_hi")).alias("_pos"))
    )
    found = counted.filter("_side = 1").select(*keys, "_pos", F.col("_us").alias("c_us"), "_ids")
    return ranges.join(found, [*keys, "_pos"]).select(
        *keys, "_p.*", "c_us", F.explode("_ids").alias("c_id")
    )


def islands(
    df: DataFrame, keys: Sequence[str], start_us: str, end_us: str, order: Sequence[str],
    slack_us: int = 0, name: str = "_island",
) -> DataFrame:
    """Number groups of overlapping intervals per key (gap larger than slack splits)."""
    out = balanced(df, keys, [start_us, *order])
    out = running(out, keys, "_chunk", [start_us, *order],
                  {"_reach": ("max", F.col(end_us))}, inclusive=False)
    begins = F.col("_reach").isNull() | (F.col(start_us) > F.col("_reach") + slack_us)
    out = materialise(out.withColumn("_begins", begins.cast("long")), "begins")  # read twice by the next running value
    out = running(out, keys, "_chunk", [start_us, *order], {name: ("sum", F.col("_begins"))})
    return out.drop("_chunk", "_reach", "_begins")


def _thinned(code: np.ndarray, us: np.ndarray, gap_us: int) -> np.ndarray:
    """Greedy thinning of rows sorted by key number and time, each key from its first row."""
    kept, bounds = [], np.append(np.flatnonzero(np.diff(code, prepend=-1)), len(code))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        while lo < hi:
            kept.append(lo)
            lo += int(np.searchsorted(us[lo:hi], us[lo] + gap_us))
    return np.array(kept, int)


def _places(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """The rows by key and time, and for each the place of its next row, its own if that lies in another chunk."""
    pdf = pdf.sort_values(["_key", "_us"], ignore_index=True)
    at = pd.Series(pdf.index, index=pd.MultiIndex.from_frame(pdf[["_key", "_us"]]))
    found = at.reindex(pd.MultiIndex.from_arrays([pdf["_key"], pdf["_next"].fillna(pdf["_us"].min() - 1).astype("int64")])).to_numpy()
    return pdf, np.where(np.isnan(found), np.arange(len(pdf)), found).astype(int)


def _leave(pdf: pd.DataFrame) -> pd.DataFrame:
    """``_out``: where a chunk is left by the chain that enters it at each row."""
    pdf, step = _places(pdf)
    while True:
        further = step[step]
        if (further == step).all():
            return pdf.assign(_out=pdf["_next"].to_numpy()[step])
        step = further


def _follow(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows on the chains that enter the chunk at its marked rows."""
    pdf, step = _places(pdf)
    on = np.zeros(len(pdf), bool)
    for at in np.flatnonzero(pdf["_enters"].to_numpy(bool)).tolist():
        while not on[at]:
            on[at] = True
            at = int(step[at])
    return pdf.loc[on, ["_key", "_us"]]


def _chain(nodes: DataFrame, rows: int) -> DataFrame:
    """Rows ``(_key, _us)`` that a key's ``_first`` row leads to, itself included, by ``_next`` pointers to later times.

    A round cuts the rows into balanced chunks and replaces each pointer by the one that leaves
    the chunk; only rows some pointer then leads to go on to the next round.  Once one
    chunk is left its chains are followed, and the rounds are undone in turn: a chunk's
    chains are followed from the rows at which the round after entered it.
    """
    fields = "_key string, _us long"
    levels, n = [], None
    while True:
        level = balanced(nodes, ["_key"], ["_us"], rows=rows)
        levels.append(level)
        size = level.count()
        if n is not None and 2 * size > n:
            rows *= 2  # a gap holds most of a chunk's rows: longer chunks
        n = size
        if n <= rows and level.select(F.max("_chunk")).first()[0] in (None, 0):
            break
        left = materialise(level.groupBy("_chunk").applyInPandas(
            lambda pdf: _leave(pdf)[["_key", "_us", "_first", "_out"]], f"{fields}, _first boolean, _out long"), "left")
        targets = left.filter("_out IS NOT NULL").select("_key", F.col("_out").alias("_us")).distinct()
        led = left.join(targets.withColumn("_led", F.lit(True)), ["_key", "_us"], "left").filter("_first OR _led")
        nodes = led.select("_key", "_us", "_first", F.col("_out").alias("_next"))
    enters = levels[-1].filter("_first").select("_key", "_us")
    for level in reversed(levels):
        marked = level.join(enters.withColumn("_enters", F.lit(True)), ["_key", "_us"], "left").select(
            "_key", "_us", "_next", "_chunk", F.coalesce("_enters", F.lit(False)).alias("_enters"))
        enters = marked.groupBy("_chunk").applyInPandas(_follow, fields)
    return enters


def spaced(df: DataFrame, keys: Sequence[str], us: str, gap_us: int, rows: int = CHUNK_ROWS) -> DataFrame:
    """Greedy thinning: keep a row if it is ``gap`` or more after the last kept one.

    Distinct times are cut into chunks of about ``rows``.  Keys that lie in one chunk are
    thinned there.  For a key that is cut, the row kept after each one is the first that is
    ``gap`` or more later, whether it is kept or not: a pointer, found by one running value
    over all chunks.  Which rows the chain from the first one meets is ``_chain``'s work.
    Returns distinct ``(keys, us)`` of the kept rows; a NULL key is a key like any other.
    """
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    names = df.select(*keys, F.col(us).alias("_us")).filter("_us IS NOT NULL").distinct().withColumn("_key", key)
    names = materialise(names, "times")
    times = balanced(names.select("_key", "_us"), ["_key"], ["_us"], rows=rows)
    cut = times.groupBy("_key").agg(F.min("_us").alias("_start"), F.min("_chunk").alias("_lo"), F.max("_chunk").alias("_hi")).filter("_lo < _hi")
    cut = materialise(cut.select("_key", "_start"), "cut")  # no more keys than chunks
    whole = times.join(F.broadcast(cut), "_key", "left_anti") if cut.limit(1).count() else times

    def thin(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_key", "_us"], ignore_index=True)
        return pdf.iloc[_thinned(pd.factorize(pdf["_key"])[0], pdf["_us"].to_numpy(), gap_us)][["_key", "_us"]]

    kept = whole.groupBy("_chunk").applyInPandas(thin, "_key string, _us long")
    if whole is not times:
        long = times.join(F.broadcast(cut), "_key").select("_key", "_us", (F.col("_us") == F.col("_start")).alias("_first"))
        none = F.lit(None).cast("long")
        seen = long.select("_key", (-F.col("_us")).alias("_back"), F.lit(0).alias("_side"), F.col("_us").alias("_at"), none.alias("_us"), F.lit(None).cast("boolean").alias("_first"))
        asks = long.select("_key", (-F.col("_us") - gap_us).alias("_back"), F.lit(1).alias("_side"), none.alias("_at"), "_us", "_first")
        both = balanced(seen.unionByName(asks), ["_key"], ["_back", "_side", "_us"], rows=rows)
        nodes = running(both, ["_key"], "_chunk", ["_back", "_side", "_us"], {"_next": ("last", F.col("_at"))}).filter("_side = 1")
        kept = kept.unionByName(_chain(nodes.select("_key", "_us", "_first", "_next"), rows))
    return names.join(kept, ["_key", "_us"], "left_semi").select(*keys, F.col("_us").alias(us))
