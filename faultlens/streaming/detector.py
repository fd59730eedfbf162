"""The metric detector as a keyed stateful stream.

State per series: its samples of the window in slots of time, each written again only
while new samples fall into it; the model in force as arrays; and a short head with the
times of the last fit and emission, the sizes of the slots and the settings in force.
A sample is scored with the stored model; only a fit, once an hour, reads the window.
Samples between two fits are scored together.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from faultlens import schemas
from faultlens.functions.columns import CONFIDENCE_CENTRE, CONFIDENCE_SLOPE, DEFAULT_THRESHOLDS, SECOND, from_micros, micros, series_key
from faultlens.operators.detect import (
    BASELINE_WINDOW_S, COOLDOWN_S, MIN_SAMPLES, PERIOD, REFIT_EVERY_S, RESIDUAL_MODES, Fit, fit_window, samples_to_signals,
)
from faultlens.operators.forest import TREES, isolation_score
from faultlens.operators.joins import sli_enrich
from faultlens.operators.series import quarantine_infinite

WATERMARK = "10 minutes"
SLOTS = 144  #: slots a default window is cut into
STRETCH = 1 << 16  #: samples that are scored together at most
HITS = (
    "series string, us long, value double, iso_score double, baseline_mean double, baseline_std double, "
    "residual double, confidence double, severity string, subject string, received long, scored long, suppressed long"
)
COUNTERS = "detector"  #: name under which the stream's counters are observed
FITS = "series string, us long, n_train long"
COLUMNS = [f.split()[0] for f in HITS.split(", ")]
TEXTS = ("series", "severity", "subject")
SUBJECT = "sli_id string, metric string, promql string, labels map<string,string>"


class DetectorState:
    """One series between samples; shared by the stream and its tests.

    ``load`` gives the stored (times, values) of a slot, ``model`` the stored fit.  What a
    caller has to write back is in ``dirty``, ``gone`` and ``fits``.
    """

    def __init__(self, settings: dict, load: Callable | None = None, model: Callable | None = None, sizes: dict | None = None,
                 fit_at: int | None = None, emit_at: int | None = None, since: int = 0):
        self.s, self.load, self.stored_model = settings, load, model
        self.stored = set(sizes or ())
        self.sizes, self.fit_at, self.emit_at, self.since = dict(sizes or {}), fit_at, emit_at, since
        self.model: Fit | None = None
        self.slots: dict[int, tuple[array, array]] = {}
        self.dirty: set[int] = set()
        self.gone: set[int] = set()
        self.fits: list[tuple[int, int]] = []
        self.scored = self.suppressed = 0

    def slot(self, number: int) -> tuple[array, array]:
        if number not in self.slots:
            stored = self.load(number) if number in self.stored and number not in self.gone else ((), ())
            self.slots[number] = (array("q", stored[0]), array("d", stored[1]))
        return self.slots[number]

    def take(self, us: int, value: float) -> None:
        self.take_all(np.array([us], np.int64), np.array([value], float))

    def take_all(self, us: np.ndarray, values: np.ndarray) -> None:
        """Take samples that lie in order of time."""
        numbers = us // self.s["slot_us"]
        edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(us)]
        for lo, hi in zip(edges[:-1], edges[1:]):
            number = int(numbers[lo])
            times, held = self.slot(number)
            times.frombytes(us[lo:hi].tobytes())
            held.frombytes(values[lo:hi].tobytes())
            self.sizes[number] = len(times)
            self.dirty.add(number)
            self.gone.discard(number)
        for old in [n for n in self.sizes if (n + 1) * self.s["slot_us"] <= int(us[-1]) - self.s["window_us"]]:
            del self.sizes[old]
            self.slots.pop(old, None)
            self.dirty.discard(old)
            if old in self.stored:
                self.gone.add(old)

    def warm(self, us: int) -> bool:
        """Whether the window holds enough samples; the slot at its edge is read only if that decides."""
        cutoff, width, least = us - self.s["window_us"], self.s["slot_us"], self.s["min_samples"]
        inside = sum(n for slot, n in self.sizes.items() if slot * width >= cutoff)
        edge = cutoff // width
        if inside >= least or edge * width >= cutoff or inside + self.sizes.get(edge, 0) < least:
            return inside >= least
        return inside + sum(t >= cutoff for t in self.slot(edge)[0]) >= least

    def history(self, us: int) -> np.ndarray:
        """Values of the window in order of time."""
        slots = [self.slot(n) for n in sorted(self.sizes)]
        times = np.concatenate([np.array(t, np.int64) for t, _ in slots])
        values = np.concatenate([np.array(v, float) for _, v in slots])
        inside = times >= us - self.s["window_us"]
        return values[inside][np.argsort(times[inside], kind="stable")]

    def feed(self, us: int, value: float) -> dict | None:
        """Take one sample; the score if it is an anomaly to emit."""
        if self.emit_at is not None and us - self.emit_at < self.s["cooldown_us"]:
            self.suppressed += 1
            return None  # suppressed samples do not enter the history
        self.take(us, value)
        if not self.warm(us):
            return None
        if self.fit_at is None or us - self.fit_at >= self.s["refit_us"]:
            train = self.history(us)
            self.model, self.fit_at, self.since = fit_window(train, self.s["period"], self.s["trees"]), us, 0
            self.fits.append((us, len(train)))
        else:
            self.since += 1
            self.model = self.model or self.stored_model()
        self.scored += 1
        _, hit = next(self._scores(np.array([value]), np.array([self.since])), (0, None))
        if hit is None:
            return None
        self.emit_at = us
        return {"us": us, "value": value, **hit}

    def _scores(self, values: np.ndarray, since: np.ndarray) -> Iterator[tuple[int, dict]]:
        """(place, what is emitted) of the values that reach a limit, were nothing suppressed."""
        limits = sorted(self.s["limits"])
        residual = values - self.model.baseline(since, self.s["residual_mode"])
        iso = isolation_score(self.model.forest, residual[:, None])
        confidence = 1.0 / (1.0 + np.exp(CONFIDENCE_SLOPE * (iso + CONFIDENCE_CENTRE)))
        for k in np.flatnonzero(confidence >= limits[0][0]).tolist() if limits else ():
            yield k, {"iso_score": float(iso[k]), "baseline_mean": self.model.mean, "baseline_std": self.model.spread, "residual": float(residual[k]),
                      "confidence": float(confidence[k]), "severity": [word for low, word in limits if low <= confidence[k]][-1]}

    def _scored_until(self, us: np.ndarray, i: int) -> int:
        """Up to where samples from ``i`` on are sure to be warm and come before the next fit; ``i`` if the first is not."""
        if self.fit_at is None:
            return i
        ahead = us[i:i + STRETCH]
        ends = min(self.fit_at + self.s["refit_us"], int(us[i]) + self.s["window_us"] // 2)
        j = i + int(np.searchsorted(ahead, ends))
        if j <= i + 1:
            return i
        cutoff, width = int(us[j - 1]) - self.s["window_us"], self.s["slot_us"]
        return j if sum(n for slot, n in self.sizes.items() if slot * width >= cutoff) >= self.s["min_samples"] else i

    def _pass(self, us: np.ndarray, values: np.ndarray) -> None:
        self.take_all(us, values)
        self.since += len(us)
        self.scored += len(us)

    def feed_all(self, us: np.ndarray, values: np.ndarray) -> list[tuple[int, dict]]:
        """(place, score) of the anomalies among samples in order of time: what ``feed`` gives for one after another."""
        out, i, cool = [], 0, self.s["cooldown_us"]
        while i < len(us):
            if self.emit_at is not None and us[i] - self.emit_at < cool:
                j = int(np.searchsorted(us, self.emit_at + cool))
                self.suppressed += j - i
                i = j
                continue
            j = self._scored_until(us, i)
            if j == i:
                hit = self.feed(int(us[i]), float(values[i]))
                out += [(i, hit)] if hit else []
                i += 1
                continue
            self.model = self.model or self.stored_model()
            first, again = i, self.s["residual_mode"] != RESIDUAL_MODES[0]
            for k, hit in self._scores(values[i:j], self.since + np.arange(1, j - i + 1)):
                k += first
                if k < i:
                    continue  # suppressed
                self._pass(us[i:k + 1], values[i:k + 1])
                self.emit_at = int(us[k])
                out.append((k, {"us": self.emit_at, "value": float(values[k]), **hit}))
                i = max(k + 1, min(j, int(np.searchsorted(us, self.emit_at + cool))))
                self.suppressed += i - k - 1
                if again and i > k + 1:
                    j = i  # suppressed samples have no phase: those that follow are scored anew
                    break
            if i < j:
                self._pass(us[i:j], values[i:j])
            i = j
        return out


_LAYOUT = (("feature", np.int32), ("threshold", np.float64), ("child", np.int32), ("path", np.float64))


def packed(fit: Fit) -> tuple:
    """A fit as a state row; the forest's arrays lie one after another, compressed."""
    forest = fit.forest
    body = b"".join(np.asarray(forest[name], kind).tobytes() for name, kind in _LAYOUT)
    return (int(forest["n_trees"]), int(forest["psi"]), len(forest["path"]), fit.mean, fit.spread, fit.last.tolist(), zlib.compress(body, 1))


def unpacked(row: tuple) -> Fit:
    trees, psi, nodes, mean, spread, last, body = row
    body, at, forest = zlib.decompress(body), 0, {"n_trees": trees, "psi": psi, "dims": 1}
    for name, kind in _LAYOUT:
        forest[name] = np.frombuffer(body, kind, nodes, at)
        at += nodes * np.dtype(kind).itemsize
    return Fit(forest, mean, spread, np.array(last))


def in_order(rows: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """Times, values, settings and subjects in order of time, and the texts that the last two are numbers of; number 0 is None.

    A row takes 24 bytes: its texts, mostly the same for a whole series, are kept once.
    """
    number, parts = {}, ([], [], [], [])
    for chunk in rows:
        parts[0].append(chunk["us"].astype("int64").to_numpy())
        parts[1].append(chunk["value"].astype("float64").to_numpy())
        for part, name in zip(parts[2:], ("settings", "subject"), strict=True):
            codes, found = pd.factorize(chunk[name])
            known = np.array([*(number.setdefault(x, len(number) + 1) for x in found.tolist()), 0], np.int32)
            part.append(known[codes])  # a missing text has the code -1
    order, out = None, []
    for part in parts:
        column = np.concatenate(part)
        part.clear()
        if order is None:
            order = np.argsort(column, kind="stable")
        out.append(column[order])
    return *out, [None, *number]


def settings_runs(settings: np.ndarray, texts: list) -> Iterator[tuple[int, int, str | None]]:
    """(first row, row past the end, text) of stretches with the same settings given."""
    edges = [0, *(np.flatnonzero(settings[1:] != settings[:-1]) + 1).tolist(), len(settings)]
    for lo, hi in zip(edges[:-1], edges[1:]):
        yield lo, hi, texts[settings[lo]]


class Detector(StatefulProcessor):
    def __init__(self, settings: dict, report: str = "hits"):
        self.settings, self.report = settings, report

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.samples = handle.getMapState("samples", "slot long", "us array<long>, value array<double>")
        self.model = handle.getValueState("model", "n_trees int, psi int, nodes int, mean double, spread double, last array<double>, forest binary")
        self.head = handle.getValueState(
            "head", "fit_at long, emit_at long, newest long, since long, timer long, slots array<long>, sizes array<int>, settings string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fit_at, emit_at, newest, since, timer, slots, sizes, own = self.head.get() if self.head.exists() else (None, None, None, 0, None, [], [], None)
        state = DetectorState(
            self.settings, lambda slot: self.samples.getValue((slot,)), lambda: unpacked(self.model.get()),
            dict(zip(slots, sizes, strict=True)), fit_at, emit_at, since)
        us, values, settings, subjects, texts = in_order(rows)
        hits = []
        for lo, hi, given in settings_runs(settings, texts):
            own = given or own  # in force from this sample on
            state.s = in_force(self.settings, own)
            hits += [{"series": key[0], **hit, "subject": texts[subjects[lo + k]]} for k, hit in state.feed_all(us[lo:hi], values[lo:hi])]
        newest = int(us[-1]) if newest is None else max(newest, int(us[-1]))
        for slot in state.gone:
            self.samples.removeKey((slot,))
        for slot in state.dirty:
            times, values = state.slots[slot]
            self.samples.updateValue((slot,), (times.tolist(), values.tolist()))
        if state.fits:
            self.model.update(packed(state.model))
        if timer is None:  # one at a time: when it expires, the series is dropped or the next one set
            timer = (newest + state.s["window_us"]) // 1000 + 1
            self.handle.registerTimer(timer)
        self.head.update((state.fit_at, state.emit_at, newest, state.since, timer, list(state.sizes), list(state.sizes.values()), own))
        if self.report == "fits":
            out = pd.DataFrame([{"series": key[0], "us": us, "n_train": n} for us, n in state.fits])
        else:  # the last row holds no hit but what is counted
            hits.append({"series": key[0], "received": len(us), "scored": state.scored, "suppressed": state.suppressed})
            whole = {c: "Int64" for c in ("us", "received", "scored", "suppressed")}
            out = pd.DataFrame({c: pd.Series([h.get(c) for h in hits], dtype=whole.get(c, object if c in TEXTS else float)) for c in COLUMNS})
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """A series without samples for a whole window is forgotten."""
        if self.head.exists():
            fit_at, emit_at, newest, since, _, slots, sizes, own = self.head.get()
            until = (newest + in_force(self.settings, own)["window_us"]) // 1000 + 1
            if until <= expiredTimerInfo.getExpiryTimeInMs():
                for state in (self.samples, self.model, self.head):
                    state.clear()
            else:
                self.handle.registerTimer(until)
                self.head.update((fit_at, emit_at, newest, since, until, slots, sizes, own))
        return iter(())

    def close(self) -> None:
        pass


def settings(window_s: int = BASELINE_WINDOW_S, period: int = PERIOD, min_samples: int = MIN_SAMPLES,
             refit_every_s: int = REFIT_EVERY_S, cooldown_s: int = COOLDOWN_S, trees: int = TREES,
             limits: list[tuple[float, str]] = DEFAULT_THRESHOLDS, residual_mode: str = RESIDUAL_MODES[0]) -> dict:
    return {
        "window_us": window_s * SECOND, "slot_us": max(SECOND, window_s * SECOND // SLOTS), "period": period, "min_samples": min_samples,
        "refit_us": refit_every_s * SECOND, "cooldown_us": cooldown_s * SECOND, "trees": trees, "limits": list(limits), "residual_mode": residual_mode,
    }


def in_force(defaults: dict, own: str | None) -> dict:
    """The defaults with what a series sets itself: window, period and limits as JSON."""
    if not own:
        return defaults
    given = json.loads(own)
    out = dict(defaults)
    if given.get("window_s") is not None:
        out["window_us"] = int(given["window_s"]) * SECOND
    if given.get("period") is not None:
        out["period"] = int(given["period"])
    if given.get("limits") is not None:
        out["limits"] = [(float(x["min"]), x["severity"]) for x in given["limits"]]
    return out


def own_settings(window_s: Column, period: Column, limits: Column) -> Column:
    """The ``settings`` column of a sample; NULL parts take the defaults."""
    return F.to_json(F.struct(window_s.alias("window_s"), period.alias("period"), limits.alias("limits")))


def _detected(samples: DataFrame, config: dict | None, report: str, output: str) -> DataFrame:
    text = [F.col(c) if c in samples.columns else F.lit(None).cast("string").alias(c) for c in ("settings", "subject")]
    rows = samples.select("series", F.col("us").cast("long").alias("us"), F.col("value").cast("double").alias("value"), *text)
    timed = rows.withColumn("_ts", from_micros(F.col("us"))).withWatermark("_ts", WATERMARK)
    return timed.groupBy("series").transformWithStateInPandas(
        statefulProcessor=Detector(config or settings(), report), outputStructType=output, outputMode="Append", timeMode="EventTime")


def stream_detector(samples: DataFrame, config: dict | None = None) -> DataFrame:
    """Emitted anomalies of a stream of finite samples ``(series, us, value)``.

    A batch's counters are observed as ``COUNTERS``: samples received, scored and
    suppressed, anomalies emitted, and the series that had samples.

    Optional columns: ``settings``, what the series sets itself (``own_settings``), and
    ``subject``, a text handed on with its anomalies.  Needs the RocksDB state store.  Rows
    are ordered by time inside a micro-batch; samples behind the watermark are not taken
    (``jobs.LateRows`` keeps them).  A series is one key and thus one task at a time; the
    poll interval bounds its rate.
    """
    rows = _detected(samples, config, "hits", HITS)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("received", "scored", "suppressed")]
    counted = rows.observe(COUNTERS, *sums, F.count("us").alias("emitted"), F.count("received").alias("active_streams"))
    return counted.filter("us IS NOT NULL").drop("received", "scored", "suppressed")


def stream_fits(samples: DataFrame, config: dict | None = None) -> DataFrame:
    """When the same detector fits a series' model anew, and from how many samples."""
    return _detected(samples, config, "fits", FITS)


def stream_tier2(samples: DataFrame, slis: DataFrame, default_cluster: str, config: dict | None = None, as_of: Column | None = None) -> DataFrame:
    """Tier-2 signals of a stream of samples ``(sli_id, labels, ts, value)``, each SLI with its own settings.

    Infinite values and samples of unknown SLIs do not pass.
    """
    good, _ = quarantine_infinite(sli_enrich(samples, slis))
    rows = good.select(
        series_key(F.col("sli_id"), F.col("labels")).alias("series"), micros(F.col("ts")).alias("us"), "value",
        own_settings(F.col("baseline_window_s"), F.col("seasonality_period"), F.col("severity_thresholds")).alias("settings"),
        F.to_json(F.struct("sli_id", "metric", "promql", "labels")).alias("subject"))
    hits = stream_detector(rows, config).withColumn("_s", F.from_json("subject", SUBJECT))
    hits = hits.select("_s.*", from_micros(F.col("us")).alias("ts"), "value", "iso_score", "baseline_mean", "baseline_std", "residual", "confidence", "severity")
    empty = F.create_map().cast(schemas.STRING_MAP)
    return samples_to_signals(hits.withColumn("labels", F.coalesce("labels", empty)), default_cluster, as_of)
