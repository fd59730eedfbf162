"""Score and rank candidate causes of an anomaly, and assemble incidents."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlens.functions.columns import SECOND, bucket, from_micros
from faultlens.operators.joins import candidate_diffs, join_dimension
from faultlens.operators.ordered import balanced, interval_join, numbered
from faultlens.session import materialise

# --- fixed values -----------------------------------------------------------
BEFORE_US = 30 * 60 * SECOND
AFTER_US = 5 * 60 * SECOND
TOP_CAUSES = 5
WEIGHTS = {"time": 0.4, "topo": 0.3, "hist": 0.2, "kind": 0.1}
# Chosen here: decay constant, prior per kind of change, share for callers.
TAU_S = 600.0
KIND_PRIOR = {
    "deploy": 1.0,
    "tf_apply": 0.9,
    "config_change": 0.6,
    "rollback": 0.5,
    "k8s_event": 0.4,
    "log_template": 0.3,
}
CALLER_SHARE = 0.5
# -----------------------------------------------------------------------------

ANY = "*"
BUCKET_US = 5 * 60 * SECOND
PLACE_ROWS = 200_000  #: subjects and candidates that one task ranks
PLACE_CELLS = 1 << 21  #: pairs that a task scores at once
NOTHING = "\0"  #: stands for a NULL service, signature or kind while rows are joined


def f_time(gap_us: Column, tau_s: float = TAU_S) -> Column:
    return F.exp(-F.abs(gap_us) / F.lit(tau_s * SECOND))


def f_topo(down: Column, up: Column) -> Column:
    """1/(1+d) along dependencies, half of that along callers, 0 if unreachable."""
    return F.coalesce(
        F.greatest(F.lit(1.0) / (F.lit(1.0) + down), F.lit(CALLER_SHARE) / (F.lit(1.0) + up)), F.lit(0.0)
    )


def f_hist(ok: Column, n: Column) -> Column:
    """Smoothed share of feedback that confirmed this kind; one half without any."""
    return (F.coalesce(ok, F.lit(0)) + F.lit(1.0)) / (F.coalesce(n, F.lit(0)) + F.lit(2.0))


def f_kind(kind: Column, prior: Mapping[str, float] = KIND_PRIOR) -> Column:
    table = F.create_map(*[F.lit(x) for pair in prior.items() for x in pair])
    return F.coalesce(table[kind], F.lit(0.0))


def history(feedback: DataFrame) -> DataFrame:
    """Feedback ``(signature, kind, correct)`` counted per signature and kind."""
    return feedback.groupBy("signature", "kind").agg(
        F.sum(F.col("correct").cast("long")).alias("ok"), F.count(F.lit(1)).alias("n"))


def score(time: Column, topo: Column, hist: Column, kind: Column,
          weights: Mapping[str, float] = WEIGHTS) -> Column:
    return (F.lit(weights["time"]) * time + F.lit(weights["topo"]) * topo
            + F.lit(weights["hist"]) * hist + F.lit(weights["kind"]) * kind)


def top_causes(scored: DataFrame, subject: Sequence[str], order: Sequence[Column], k: int = TOP_CAUSES) -> DataFrame:
    """First k rows per subject.  The rank limit is applied before the shuffle as well."""
    w = W.partitionBy(*subject).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _nearest(times: np.ndarray, asked: np.ndarray, k: int, before_us: int, after_us: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``times`` (asked, 2 k) of the rows of one class that can be among its k nearest, and whether they are in the window.

    The class is sorted by time and id.  Of rows at or before the time asked for, later ones
    come first, and of equal times the smallest ids.
    """
    n = len(times)
    after = np.searchsorted(times, asked, "right")
    back = np.lexsort((np.arange(n), -times))
    steps = np.arange(k)
    early, late = (n - after)[:, None] + steps, after[:, None] + steps
    place = np.concatenate([back[np.minimum(early, n - 1)], np.minimum(late, n - 1)], axis=1)
    gap = times[place] - asked[:, None]
    return place, np.concatenate([early < n, late < n], axis=1) & (gap >= -before_us) & (gap <= after_us)


def _groups(table: pa.Table, *names: str) -> dict[tuple, np.ndarray]:
    """The rows of each group, in order."""
    code = np.zeros(table.num_rows, np.int64)
    for name in names:
        words = table.column(name).combine_chunks().dictionary_encode()
        code = np.unique(code * (len(words.dictionary) + 1) + words.indices.to_numpy(), return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    firsts = np.flatnonzero(np.diff(code[order], prepend=-1))
    keys = zip(*(table.column(n).take(pa.array(order[firsts])).to_pylist() for n in names))
    return dict(zip(keys, np.split(order, firsts[1:])))


def _placing(rows: pa.Table, k: int, before_us: int, after_us: int, fall: Callable, unknown: float, prior: Mapping[str, float], slack: float) -> tuple[pa.Table, pa.Table]:
    """Subjects and candidates, row by row, of the pairs of a chunk that can reach the top k.

    Scores are only estimated here, to leave out pairs that are more than ``slack`` below the k-th best.
    """
    asks = rows.filter(pc.field("ask")).combine_chunks()
    cands = rows.filter(~pc.field("ask"))
    cands = cands.take(pc.sort_indices(cands, [("us", "ascending"), ("cand_id", "ascending")], null_placement="at_start")).combine_chunks()
    asked, when, places = asks.column("us").to_numpy(), cands.column("us").to_numpy(), cands.column("service")
    named, anywhere = {}, {}
    for (cluster, place, kind), own in _groups(cands, "cluster", "service", "kind").items():
        named.setdefault((cluster, place), []).append((kind, own))
    for (cluster, kind), own in _groups(cands, "cluster", "kind").items():
        anywhere.setdefault(cluster, []).append((kind, own))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for (cluster, _, _), mine in _groups(asks, "cluster", "service", "signature").items():
        first = int(mine[0])
        reach = {x["place"]: x["topo"] for x in asks.column("reach")[first].as_py() or ()}
        past = {x["kind"]: x["hist"] for x in asks.column("past")[first].as_py() or ()}
        near = pc.is_in(places, pa.array(list(reach), pa.string())).to_numpy(zero_copy_only=False)
        classes = [(own, topo + past.get(kind, unknown) + prior.get(kind, 0.0), False) for place, topo in reach.items() for kind, own in named.get((cluster, place), ())]
        classes += [(own, past.get(kind, unknown) + prior.get(kind, 0.0), True) for kind, own in anywhere.get(cluster, ())]
        step = max(1, PLACE_CELLS // max(1, 2 * k * len(classes)))
        for lo in range(0, len(mine) if classes else 0, step):
            part = mine[lo:lo + step]
            found, scores = [], []
            for own, fixed, rest in classes:
                at, ok = _nearest(when[own], asked[part], k, before_us, after_us)
                at = own[at]
                ok &= ~(near[at] & rest)
                found.append(np.where(ok, at, -1))
                scores.append(np.where(ok, fall(when[at] - asked[part][:, None]) + fixed, -np.inf))
            found, scores = np.concatenate(found, axis=1), np.concatenate(scores, axis=1)
            least = np.partition(scores, -k, axis=1)[:, -k]
            a, c = np.nonzero((found >= 0) & (scores >= least[:, None] - slack))
            left.append(part[a])
            right.append(found[a, c])
    return asks.take(pa.array(np.concatenate(left))), cands.take(pa.array(np.concatenate(right)))


def nearest_pairs(subjects: DataFrame, candidates: DataFrame, distances: DataFrame, hist: DataFrame, k: int, before_us: int, after_us: int,
                  weights: Mapping[str, float] = WEIGHTS, prior: Mapping[str, float] = KIND_PRIOR, tau_s: float = TAU_S) -> DataFrame:
    """The pairs that can reach the top k, without forming the others.

    Candidates of one cluster, service and kind differ in their score only through
    the time gap, so of each such class only those nearest to the onset can place.
    Services out of reach all score the same for topology; they form one further
    class per kind.  Reachable services found there score higher still, so dropping
    them (they came through their own class) cannot cost an unreachable one its place.

    Subjects and candidates of a cluster lie side by side in chunks of time that hold equally
    many rows.  A chunk is given what its neighbours hold nearest to it, k rows of each
    class on either side, so that its subjects meet all they need in one task.
    """
    here = ["cluster", "service", "kind"]

    def first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
        w = W.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")

    cands = first(candidates.select(*here, F.col("c_us").alias("us"), "cand_id").dropna(subset=["cluster", "us"]), [*here, "us"], [F.asc("cand_id")])
    asks = subjects.select("cluster", "service", "signature", F.col("a_us").alias("us"), F.lit(True).alias("ask")).dropna(subset=["cluster", "us"])
    both = materialise(asks.unionByName(cands.withColumn("ask", F.lit(False)), allowMissingColumns=True), "sides")
    parts = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = balanced(both, ["cluster"], ["us"], rows=max(1, min(PLACE_ROWS, both.count() // parts)))

    spans = stored.filter("ask").groupBy("cluster", F.col("_chunk").alias("_to")).agg(F.min("us").alias("_lo"), F.max("us").alias("_hi"))
    held = stored.filter("NOT ask")
    halo = None
    for order, side in (([F.desc("us"), F.asc("cand_id")], (F.col("_chunk") < F.col("_to")) & (F.col("us") >= F.col("_lo") - before_us)),
                        ([F.asc("us"), F.asc("cand_id")], (F.col("_chunk") > F.col("_to")) & (F.col("us") <= F.col("_hi") + after_us))):
        edge = first(held, [*here, "_chunk"], order).join(spans, "cluster").filter(side)
        edge = first(edge, [*here, "_to"], order).drop("_lo", "_hi", "_chunk").withColumnRenamed("_to", "_chunk")
        halo = edge if halo is None else halo.unionByName(edge)

    reach = distances.groupBy("service").agg(F.collect_list(F.struct(
        F.col("cause_service").alias("place"), (F.lit(weights["topo"]) * f_topo(F.col("down"), F.col("up"))).alias("topo"))).alias("reach"))
    past = hist.groupBy("signature").agg(F.collect_list(F.struct("kind", (F.lit(weights["hist"]) * f_hist(F.col("ok"), F.col("n"))).alias("hist"))).alias("past"))
    told = join_dimension(join_dimension(stored.filter("ask"), reach, ["service"]), past, ["signature"])
    rows = told.unionByName(held.unionByName(halo), allowMissingColumns=True)

    kinds = {x: weights["kind"] * p for x, p in prior.items()}
    slack = 1e-9 * max(1.0, sum(weights.values()) * max([1.0, *prior.values()]))  # far more than rounding moves a score

    def run(table: pa.Table) -> pa.Table:
        a, c = _placing(table, k, before_us, after_us, lambda gap: weights["time"] * np.exp(-np.abs(gap) / (tau_s * SECOND)), 0.5 * weights["hist"], kinds, slack)
        return pa.table({**{n: a.column(n) for n in ("cluster", "service", "signature")}, "a_us": a.column("us"), "kind": c.column("kind"),
                         "c_us": c.column("us"), "cand_id": c.column("cand_id"), "cause_service": c.column("service")})

    cand_id = candidates.schema["cand_id"].dataType.simpleString()
    return rows.groupBy("_chunk").applyInArrow(
        run, f"cluster string, service string, signature string, a_us long, kind string, c_us long, cand_id {cand_id}, cause_service string")


def rank_causes(
    anomalies: DataFrame,
    candidates: DataFrame,
    distances: DataFrame,
    hist: DataFrame,
    k: int = TOP_CAUSES,
    before_us: int = BEFORE_US,
    after_us: int = AFTER_US,
    weights: Mapping[str, float] = WEIGHTS,
    prior: Mapping[str, float] = KIND_PRIOR,
    tau_s: float = TAU_S,
) -> DataFrame:
    """Top k causes per anomaly inside its window.

    anomalies ``(anomaly_id, cluster, service, signature, a_us)``, candidates
    ``(cand_id, cluster, service, kind, c_us)``, distances ``(service, cause_service,
    down, up)``, hist ``(signature, kind, ok, n)``.

    Only the pairs that can place are formed (``nearest_pairs``), for which no weight may
    be negative.  A NULL service is out of every service's reach, a NULL signature or
    kind has no history and a NULL kind no prior; such rows are ranked like others.
    """
    if min(weights.values()) < 0:
        raise ValueError("weights may not be negative")

    def filled(df: DataFrame, *names: str) -> DataFrame:
        return df.withColumns({n: F.coalesce(n, F.lit(NOTHING)) for n in names})

    subject = ["cluster", "service", "signature", "a_us"]
    anomalies = filled(anomalies, "service", "signature")
    subjects = anomalies.select(*subject).distinct()
    distances = materialise(distances, "distances")
    pairs = nearest_pairs(subjects, filled(candidates, "service", "kind"), distances, hist, k, before_us, after_us, weights, prior, tau_s)
    pairs = join_dimension(pairs, distances, ["service", "cause_service"])
    pairs = join_dimension(pairs, hist, ["signature", "kind"])
    scored = pairs.withColumn(
        "_score",
        score(f_time(F.col("c_us") - F.col("a_us"), tau_s), f_topo(F.col("down"), F.col("up")),
              f_hist(F.col("ok"), F.col("n")), f_kind(F.col("kind"), prior), weights),
    )
    nearer = F.abs(F.col("c_us") - F.col("a_us")).asc()
    ranked = top_causes(scored, subject, [F.desc("_score"), nearer, F.asc("cand_id")], k)
    rows = anomalies.join(ranked, subject).select(
        "anomaly_id", *subject, "rank", "cand_id", "kind", "cause_service", "c_us",
        F.round("_score", 6).alias("score"))
    return rows.withColumns({n: F.nullif(n, F.lit(NOTHING)) for n in ("service", "signature", "kind", "cause_service")})


def pull_window(anomalies: DataFrame, candidates: DataFrame, keys: Sequence[tuple[str, str]],
                before_us: int = BEFORE_US, after_us: int = AFTER_US) -> DataFrame:
    """All candidates in each anomaly's window, for keys under which windows stay short."""
    return interval_join(anomalies, candidates, keys, "a_us", "c_us", before_us, after_us)


def gap_text(gap_us: Column) -> Column:
    """``T-137s`` before onset, ``T+12s`` after; minutes from ten minutes on."""
    s = F.floor(F.abs(gap_us) / SECOND).cast("long")
    amount = F.when(s >= 600, F.concat(F.floor(s / 60).cast("string"), F.lit("m"))).otherwise(
        F.concat(s.cast("string"), F.lit("s")))
    return F.concat(F.lit("T"), F.when(gap_us > 0, F.lit("+")).otherwise(F.lit("-")), amount)


def cause_summary(kind: Column, service: Column, at: Column, gap_us: Column) -> Column:
    return F.format_string("%s of %s at %s (%s)", kind, service, F.date_format(at, "HH:mm:ss"), gap_text(gap_us))


def build_incidents(ranked: DataFrame) -> DataFrame:
    """One row per anomaly with its causes as an array in rank order; ``summary`` and ``diff_summary`` come along if given."""
    told = [c for c in ("summary", "diff_summary") if c in ranked.columns]
    cause = F.struct("rank", "score", "kind", F.col("cand_id").alias("change_event_id"), "cause_service", *told)
    return ranked.groupBy("anomaly_id", "cluster", "service", "a_us").agg(
        F.sort_array(F.collect_list(cause)).alias("ranked_candidate_causes"))


def told_causes(ranked: DataFrame, diffs: DataFrame) -> DataFrame:
    """Ranked causes with a sentence on each, and what it changed from ``diffs(change_event_id, diff_summary)``."""
    gap = F.col("c_us") - F.col("a_us")
    text = cause_summary(F.coalesce("kind", F.lit("change")), F.coalesce("cause_service", F.lit("an unknown service")), from_micros(F.col("c_us")), gap)
    rows = ranked.withColumn("summary", text).withColumn("change_event_id", F.col("cand_id"))
    return candidate_diffs(rows, diffs).drop("change_event_id")


def incident_context(incidents: DataFrame, anomalies: DataFrame, slices: DataFrame,
                     deltas: DataFrame | Callable[[DataFrame], DataFrame], similar: DataFrame) -> DataFrame:
    """The nested document of an incident as JSON, template shifts at its own onset, sharpest first.

    incidents ``(incident_id, anomaly_id, cluster, service, ranked_candidate_causes)``, anomalies
    ``(anomaly_id, signal, metric, severity, started_at, baseline, observed, duration_so_far_s)``,
    slices ``(service, upstream_callers, downstream_deps)``, deltas ``(anomaly_id, service, template,
    count_before, count_after, example_fields)``, similar ``(anomaly_id, incident_id, similarity,
    resolution)``.  Lists an incident has nothing for are empty.

    ``deltas`` may also be a function that adds ``log_pattern_deltas``, in order, to rows with an
    ``anomaly_id``: it is given all else of the documents, so that the long lists stay where they are.
    """
    def listed(rows: DataFrame, order: Column, fields: Sequence[str], name: str) -> DataFrame:
        def first(a: Column, b: Column) -> Column:  # maps cannot be compared, so the entries themselves are not
            return F.when(a["_order"] < b["_order"], -1).when(a["_order"] > b["_order"], 1).otherwise(0)

        entries = F.array_sort(F.collect_list(F.struct(order.alias("_order"), F.struct(*fields).alias("_entry"))), first)
        return rows.groupBy("anomaly_id").agg(F.transform(entries, lambda x: x["_entry"]).alias(name))

    past = listed(similar, F.struct((-F.col("similarity")).alias("less"), "incident_id"), ["incident_id", "similarity", "resolution"], "similar_past_incidents")
    doc = (
        incidents.join(anomalies, "anomaly_id")
        .join(slices, "service", "left")
        .join(past, "anomaly_id", "left")
    )
    if callable(deltas):
        doc = deltas(doc)
    else:
        shift = F.round(F.abs(F.log((F.col("count_after") + 1.0) / (F.col("count_before") + 1.0))), 9)
        shifts = listed(deltas, F.struct((-shift).alias("shift"), "service", "template"), ["service", "template", "count_before", "count_after", "example_fields"], "log_pattern_deltas")
        doc = doc.join(shifts, "anomaly_id", "left")

    def whole(name: str, kind: str) -> Column:
        return F.coalesce(F.col(name), F.array().cast(kind)).alias(name)

    kinds = dict(doc.dtypes)
    return doc.select(
        "anomaly_id",
        F.to_json(F.struct(
            "incident_id",
            "cluster",
            F.struct("signal", "metric", "service", "started_at", "severity", "baseline", "observed",
                     "duration_so_far_s").alias("anomaly"),
            F.struct(F.col("service").alias("affected_service"), whole("upstream_callers", "array<string>"), whole("downstream_deps", "array<string>")).alias("topology"),
            whole("log_pattern_deltas", kinds["log_pattern_deltas"]),
            "ranked_candidate_causes",
            whole("similar_past_incidents", kinds["similar_past_incidents"]),
        )).alias("document"),
    )


def union_signals(tier1: DataFrame, tier2: DataFrame) -> DataFrame:
    return tier1.unionByName(tier2, allowMissingColumns=True)


def union_candidates(**kinds: DataFrame) -> DataFrame:
    """Candidates ``(cand_id, cluster, service, c_us)`` of several kinds in one frame.

    Frames that state their own ``kind`` (changes) keep it; the others get their name.
    """
    rows = None
    for name, frame in kinds.items():
        kind = F.col("kind") if "kind" in frame.columns else F.lit(name).alias("kind")
        part = frame.select(F.col("cand_id").cast("string").alias("cand_id"), "cluster", "service", kind, "c_us")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def incident_timeline(parts: Mapping[str, DataFrame], chunk_us: int = BUCKET_US) -> DataFrame:
    """Entries ``(incident_id, us, entry_id, text)`` of several kinds with their position in time."""
    entries = None
    for kind, part in parts.items():
        rows = part.select("incident_id", "us", F.lit(kind).alias("kind"), "entry_id", "text")
        entries = rows if entries is None else entries.unionByName(rows)
    chunked = entries.withColumn("_chunk", bucket(F.col("us"), chunk_us))
    return numbered(chunked, ["incident_id"], "_chunk", ["us", "kind", "entry_id"], "position").drop("_chunk")


def incident_detail(incidents: DataFrame, incident_id: str, column: str = "incident_id") -> DataFrame:
    return incidents.filter(F.col(column) == incident_id)


def incident_page(incidents: DataFrame, order: Sequence[Column], page: int, size: int,
                  where: Column | None = None) -> DataFrame:
    rows = incidents if where is None else incidents.filter(where)
    return rows.orderBy(*order).offset(page * size).limit(size)
