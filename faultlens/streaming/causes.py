"""Ranked causes as a stream: each anomaly's best candidates once its window has closed.

Anomalies and candidates of one cluster and block of time meet in keyed state; a candidate
is copied to each block whose anomalies can reach it.  The earliest waiting anomaly of a block
has a timer at the end of its window; when the watermark passes it, the candidates of the window
are scored and the best few are emitted, or one row without a candidate if there are none.
A block goes once no anomaly that may still come belongs to it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from itertools import groupby, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from faultlens.functions.columns import SECOND, bucket, from_micros
from faultlens.operators import correlate as cr

WATERMARK = "10 minutes"
BLOCK_US = 30 * 60 * SECOND
OUTPUT = "anomaly_id string, cluster string, rank int, cand_id string, kind string, cause_service string, c_us long, score double"


class Ranker(StatefulProcessor):
    def __init__(self, k: int, before_us: int, after_us: int, weights: Mapping[str, float], tau_s: float):
        self.k, self.before, self.after, self.weights, self.tau = k, before_us, after_us, dict(weights), tau_s * SECOND

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.candidates = handle.getListState("candidates", "us array<long>, row array<string>")
        self.pending = handle.getListState("pending", "id array<string>, us array<long>, near array<string>")

    def _due(self, us: int) -> int:
        """The time in ms at which an anomaly's window has passed."""
        return (us + self.after) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        asks, found = batch[batch["what"] == 1], batch[batch["what"] == 0]
        if len(asks):
            us = asks["us"].astype("int64").tolist()
            self.pending.appendValue((asks["id"].tolist(), us, asks["near"].tolist()))
            self.handle.registerTimer(self._due(min(us)))
        if len(found):
            self.candidates.appendValue((found["us"].astype("int64").tolist(), found["row"].tolist()))
        self.handle.registerTimer(self._due((key[1] + 1) * BLOCK_US))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        waiting = {n: (u, t) for names, us, near in self.pending.get() for n, u, t in zip(names, us, near, strict=True)}
        closed = [(n, u, t) for n, (u, t) in waiting.items() if self._due(u) <= now]
        if closed:
            pool = [(u, json.loads(r)) for us, rows in self.candidates.get() for u, r in zip(us, rows, strict=True)]
            yield pd.DataFrame(self._ranked(key[0], closed, pool), columns=["anomaly_id", "cluster", "rank", "cand_id", "kind", "cause_service", "c_us", "score"]).astype(
                {"rank": "Int32", "c_us": "Int64"})
        if self._due((key[1] + 1) * BLOCK_US) <= now:  # whatever else belongs here would be late
            self.pending.clear()
            self.candidates.clear()
        elif closed:
            rest = [(n, u, t) for n, (u, t) in waiting.items() if self._due(u) > now]
            self.pending.clear()
            if rest:
                self.pending.appendValue(tuple(list(c) for c in zip(*rest, strict=True)))
                self.handle.registerTimer(self._due(min(u for _, u, _ in rest)))

    def _ranked(self, cluster, asks: list, pool: list) -> list:
        """The rows of the best candidates of each of the asks ``(id, us, near)``.

        Candidates of one service and kind differ in their score only through the time gap, so of
        each such class only those nearest on either side are scored.
        """
        w, kinds, nearest = self.weights, {}, 2 * self.k if self.weights["time"] >= 0 else len(pool)
        for u, (cand_id, service, kind, prior) in pool:
            kinds.setdefault((service, kind, prior), []).append((u, len(cand_id or ""), cand_id or "", cand_id))  # ids that are numbers go by size
        at, known = np.array([u for _, u, _ in asks], np.int64), {}
        for _, _, text in asks:
            known.setdefault(text, (len(known), json.loads(text)))
        texts = np.array([known[text][0] for _, _, text in asks])
        parts, listed = [], []
        for (service, kind, prior), members in kinds.items():
            members.sort(key=lambda m: m[:3])
            if nearest < len(pool):
                members = [m for _, same in groupby(members, key=lambda m: m[0]) for m in islice(same, self.k)]
            us = np.array([m[0] for m in members], np.int64)
            here = np.searchsorted(us, at)
            lo = np.maximum(np.searchsorted(us, at - self.before), here - nearest)
            n = np.maximum(np.minimum(np.searchsorted(us, at + self.after, "right"), here + nearest) - lo, 0)
            ask = np.repeat(np.arange(len(at)), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - lo, n)
            gap = np.abs(us[place] - at[ask])
            topo, hist = (np.array([table[name].get(at_key, none) for _, table in known.values()]) for name, at_key, none in (("topo", service, 0.0), ("hist", kind, 0.5)))
            score = w["time"] * np.exp(-gap / self.tau) + w["topo"] * topo[texts[ask]] + w["hist"] * hist[texts[ask]] + w["kind"] * float(prior)
            parts.append((ask, score, gap, place + len(listed)))
            listed += [(m[1], m[2], m[3], kind, service, m[0]) for m in members]
        best = [[] for _ in asks]
        if listed:
            ask, score, gap, place = (np.concatenate(c) for c in zip(*parts, strict=True))
            by_id = np.empty(len(listed), np.int64)
            by_id[sorted(range(len(listed)), key=lambda i: listed[i][:2])] = np.arange(len(listed))
            order = np.lexsort((by_id[place], gap, -score, ask))
            first = np.arange(len(order)) - np.searchsorted(ask[order], ask[order]) < self.k
            for i in order[first].tolist():
                _, _, cand_id, kind, service, u = listed[place[i]]
                best[ask[i]].append([asks[ask[i]][0], cluster, len(best[ask[i]]) + 1, cand_id, kind, service, u, round(float(score[i]), 6)])
        return [r for (name, _, _), rows in zip(asks, best, strict=True) for r in rows or [[name, cluster, None, None, None, None, None, None]]]

    def close(self) -> None:
        pass


def rank_stream(anomalies: DataFrame, candidates: DataFrame, distances: DataFrame, hist: DataFrame, k: int = cr.TOP_CAUSES,
                before_us: int = cr.BEFORE_US, after_us: int = cr.AFTER_US, weights: Mapping[str, float] = cr.WEIGHTS,
                prior: Mapping[str, float] = cr.KIND_PRIOR, tau_s: float = cr.TAU_S) -> DataFrame:
    """The k best causes of each anomaly of a stream, or one row of NULLs for an anomaly without candidates.

    Streams ``anomalies (anomaly_id, cluster, service, signature, a_us)`` and ``candidates
    (cand_id, cluster, service, kind, c_us)``; tables ``distances`` and ``hist`` as in
    ``correlate.rank_causes``.  Rows behind the watermark are not taken.  Needs the RocksDB
    state store.  A cluster is one key per block of time.
    """
    reach = distances.groupBy("service").agg(F.map_from_entries(F.collect_list(F.struct("cause_service", cr.f_topo(F.col("down"), F.col("up"))))).alias("topo"))
    known = hist.groupBy("signature").agg(F.map_from_entries(F.collect_list(F.struct("kind", cr.f_hist(F.col("ok"), F.col("n"))))).alias("hist"))
    empty = F.create_map().cast("map<string,double>")
    near = F.to_json(F.struct(F.coalesce("topo", empty).alias("topo"), F.coalesce("hist", empty).alias("hist")))
    asks = anomalies.join(reach, "service", "left").join(known, "signature", "left").select(
        "cluster", F.lit(1).alias("what"), F.col("a_us").alias("us"), F.col("anomaly_id").cast("string").alias("id"),
        near.alias("near"), F.lit(None).cast("string").alias("row"), bucket(F.col("a_us"), BLOCK_US).alias("block"))
    row = F.to_json(F.array(F.col("cand_id").cast("string"), "service", "kind", cr.f_kind(F.col("kind"), prior).cast("string")))
    found = candidates.select("cluster", F.lit(0).alias("what"), F.col("c_us").alias("us"), F.lit(None).cast("string").alias("id"),
                              F.lit(None).cast("string").alias("near"), row.alias("row"),
                              F.explode(F.sequence(bucket(F.col("c_us") - after_us, BLOCK_US), bucket(F.col("c_us") + before_us, BLOCK_US))).alias("block"))
    both = asks.unionByName(found).withColumn("_ts", from_micros(F.col("us"))).withWatermark("_ts", WATERMARK)
    return both.groupBy("cluster", "block").transformWithStateInPandas(
        statefulProcessor=Ranker(k, before_us, after_us, weights, tau_s), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")
