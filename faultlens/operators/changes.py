"""Change events of four sources in one schema, and structural diffs."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultlens.functions.columns import first_non_empty
from faultlens.schemas import CHANGE_EVENT

STRINGS = "map<string,string>"


def _path(doc: Column, *paths: str) -> Column:
    return first_non_empty(*[F.get_json_object(doc, p) for p in paths])


def _change(body: Column, source: str, event_type: Column, ts: Column, actor: Column, target: dict[str, Column],
            git: dict[str, Column], diff_ref: Column) -> Column:
    nothing = F.lit(None).cast("string")
    return F.struct(
        event_type.alias("event_type"), F.lit(source).alias("source"), F.try_to_timestamp(ts).alias("ts"), actor.alias("actor"),
        F.struct(*[target.get(n, nothing).alias(n) for n in ("kind", "namespace", "name", "cluster")]).alias("target"),
        F.struct(git.get("repo", nothing).alias("repo"), git.get("sha", nothing).alias("sha"),
                 git.get("pr", nothing).try_cast("int").alias("pr")).alias("git"),
        diff_ref.alias("diff_ref"),
    )


def _argocd(b: Column) -> Column:
    rolled = _path(b, "$.app.status.operationState.operation.rollback").isNotNull()
    return _change(
        b, "argocd", F.when(rolled, "rollback").otherwise("deploy"),
        _path(b, "$.app.status.operationState.finishedAt", "$.timestamp"),
        _path(b, "$.app.status.operationState.operation.initiatedBy.username"),
        {"kind": F.lit("Application"), "namespace": _path(b, "$.app.spec.destination.namespace"),
         "name": _path(b, "$.app.metadata.name"), "cluster": _path(b, "$.app.spec.destination.name")},
        {"repo": _path(b, "$.app.spec.source.repoURL"), "sha": _path(b, "$.app.status.sync.revision")},
        F.lit(None).cast("string"))


def _cloudbuild(b: Column) -> Column:
    return _change(
        b, "cloudbuild", F.lit("deploy"), _path(b, "$.finishTime", "$.createTime"), _path(b, "$.substitutions._ACTOR"),
        {"kind": F.lit("Deployment"), "namespace": _path(b, "$.substitutions._NAMESPACE"),
         "name": _path(b, "$.substitutions._SERVICE"), "cluster": _path(b, "$.substitutions._CLUSTER")},
        {"repo": _path(b, "$.substitutions.REPO_NAME"), "sha": _path(b, "$.substitutions.COMMIT_SHA")},
        _path(b, "$.logUrl"))


def _atlantis(b: Column) -> Column:
    return _change(
        b, "atlantis", F.lit("tf_apply"), _path(b, "$.timestamp"), _path(b, "$.user.username"),
        {"kind": F.lit("Terraform"), "name": _path(b, "$.project.name", "$.directory"), "cluster": _path(b, "$.workspace")},
        {"repo": _path(b, "$.repo.full_name"), "sha": _path(b, "$.pull.head_commit"), "pr": _path(b, "$.pull.num")},
        _path(b, "$.plan_url"))


def _github(b: Column) -> Column:
    return _change(
        b, "github", F.lit("config_change"), _path(b, "$.head_commit.timestamp", "$.pull_request.merged_at"),
        _path(b, "$.sender.login"),
        {"kind": F.lit("Repository"), "name": _path(b, "$.repository.name")},
        {"repo": _path(b, "$.repository.full_name"), "sha": _path(b, "$.after", "$.pull_request.merge_commit_sha"),
         "pr": _path(b, "$.pull_request.number")},
        _path(b, "$.compare", "$.pull_request.diff_url"))


SOURCES = {"argocd": _argocd, "cloudbuild": _cloudbuild, "atlantis": _atlantis, "github": _github}


def normalise_changes(raw: DataFrame, value: str = "value", source: str = "source",
                      ref: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Canonical change events, and bodies that name no source, time or target.

    The id is derived from the body, so a webhook delivered twice gives one id.
    """
    body = F.col(value)
    one = F.lit(None)
    for name, reader in SOURCES.items():
        one = F.when(F.col(source) == name, reader(body)).otherwise(one)
    keep = [c for c in raw.columns if c not in (value, source)]
    rows = raw.select(*keep, value, source, F.explode(F.array(one)).alias("_c"))
    usable = F.col("_c.ts").isNotNull() & F.col("_c.target.name").isNotNull()
    ref = F.lit(None).cast("string") if ref is None else ref
    good = rows.filter(usable).select(
        *keep, F.substring(F.sha2(F.concat_ws("|", source, value), 256), 1, 32).alias("event_id"),
        *[F.col(f"_c.{n}").alias(n) for n in CHANGE_EVENT.fieldNames() if n not in ("event_id", "raw_payload_ref")],
        ref.alias("raw_payload_ref"))
    bad = rows.filter(~F.coalesce(usable, F.lit(False))).drop("_c").withColumn("reason", F.lit("unknown change"))
    return good, bad


PLAN = "resource_changes array<struct<address:string,type:string,name:string,change:struct<actions:array<string>,before:string,after:string>>>"


def plan_diff(plans: DataFrame, value: str = "value") -> DataFrame:
    """Changed attributes of every resource of a plan document, with the value on both sides."""
    keep = [c for c in plans.columns if c != value]
    doc = F.from_json(value, PLAN)
    rows = plans.select(*keep, F.explode(doc["resource_changes"]).alias("_r"))
    empty = F.create_map().cast(STRINGS)
    sides = rows.select(
        *keep, F.col("_r.address").alias("address"), F.col("_r.type").alias("kind"), F.col("_r.name").alias("name"),
        F.coalesce(F.from_json("_r.change.before", STRINGS), empty).alias("_b"),
        F.coalesce(F.from_json("_r.change.after", STRINGS), empty).alias("_a"))
    keys = F.array_union(F.map_keys("_b"), F.map_keys("_a"))
    pairs = sides.select(*keep, "address", "kind", "name", "_b", "_a", F.explode(keys).alias("path"))
    pairs = pairs.select(*keep, "address", "kind", "name", "path",
                         F.col("_b")[F.col("path")].alias("old"), F.col("_a")[F.col("path")].alias("new"))
    return pairs.filter(~F.col("old").eqNullSafe(F.col("new")))


class _Number(str):
    """A JSON number as it is written."""


LEAF = "array<struct<path:string,kind:string,leaf:string>>"
KINDS = {str: "string", _Number: "number", bool: "boolean", type(None): "null", dict: "object", list: "array"}


def _step(key: str) -> str:
    """An object key in a path: its own dots and brackets are escaped, so no two keys read alike."""
    return re.sub(r"([\\.\[])", r"\\\1", key)


_TOKEN = re.compile(r'[ \t\n\r]*(?:([{}\[\],:])|("(?:[^"\\\x00-\x1f]|\\.)*")|(-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|-?Infinity|NaN)|(true|false|null))')
_WORDS = {"true": True, "false": False, "null": None}


def _deep(text: str):
    """What ``json.loads`` gives, for documents too deep for it: open objects and lists are on a list, not on the call stack."""
    open_, at, result = [], 0, []
    holder, key, want = result, None, "value"  # want: value, item (or an end), name (or an end), next
    while True:
        m = _TOKEN.match(text, at)
        if m is None:
            if not text[at:].strip(" \t\n\r") and want == "next" and not open_:
                return result[0]
            raise ValueError("no JSON")
        at = m.end()
        sign, quoted, number, word = m.groups()
        if want == "next":
            if not open_ or sign not in ("," , "]", "}") or (sign != "," and (sign == "}") != isinstance(holder, dict)):
                raise ValueError("no JSON")
            if sign == ",":
                want = "key" if isinstance(holder, dict) else "value"
            else:
                holder, key = open_.pop()
            continue
        if want in ("name", "key"):
            if want == "name" and sign == "}":
                holder, key = open_.pop()
                want = "next"
                continue
            colon = _TOKEN.match(text, at)
            if quoted is None or colon is None or colon[1] != ":":
                raise ValueError("no JSON")
            key, at, want = json.loads(quoted), colon.end(), "value"
            continue
        if want == "item" and sign == "]":
            holder, key = open_.pop()
            want = "next"
            continue
        if sign in ("{", "["):
            value = {} if sign == "{" else []
        elif sign is not None:
            raise ValueError("no JSON")
        else:
            value = json.loads(quoted) if quoted is not None else _Number(number) if number is not None else _WORDS[word]
        if isinstance(holder, dict):
            holder[key] = value
        else:
            holder.append(value)
        if sign is None:
            want = "next"
        else:
            open_.append((holder, key))
            holder, want = value, "name" if sign == "{" else "item"


def _parsed(text: str):
    try:
        return json.loads(text, parse_int=_Number, parse_float=_Number, parse_constant=_Number)
    except RecursionError:
        return _deep(text)


def json_leaves(text: str | None) -> list[tuple[str, str, str | None]]:
    """(path, kind, leaf) of every leaf; objects give ``a.b``, arrays ``a[0]``, empty ones are leaves themselves."""
    if text is None:
        return []
    try:
        stack = [("", _parsed(text))]
    except ValueError:
        return [("", "text", text)]
    out = []
    while stack:
        path, value = stack.pop()
        if isinstance(value, dict) and value:
            stack += [(f"{path}.{_step(k)}" if path else _step(k), v) for k, v in value.items()]
        elif isinstance(value, list) and value:
            stack += [(f"{path}[{i}]", v) for i, v in enumerate(value)]
        else:
            shown = {True: "true", False: "false"}[value] if isinstance(value, bool) else None if value is None else "{}" if value == {} else "[]" if value == [] else str(value)
            out.append((path, KINDS[type(value)], shown))
    return out


def leaves(docs: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys, path, kind, leaf)`` for every leaf of a JSON document, however deep.

    Text inside a string stays a string.  What is no JSON is one leaf of kind text.
    """
    @F.pandas_udf(LEAF)
    def walk(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [dict(zip(("path", "kind", "leaf"), x)) for x in json_leaves(t)])

    return docs.select(*keys, F.explode(walk(F.col(value))).alias("_e")).select(*keys, "_e.path", "_e.kind", "_e.leaf")


def _sides(frames: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per (keys, path) with each frame's leaf and kind, in a single shuffle; a side without the path has no kind."""
    rows = None
    for name, frame in frames.items():
        part = frame.select(*keys, "path", "kind", "leaf", F.lit(name).alias("_side"))
        rows = part if rows is None else rows.unionByName(part)
    picks = []
    for name in frames:
        mine = F.col("_side") == name
        picks.append(F.max(F.when(mine, F.col("leaf"))).alias(name))
        picks.append(F.max(F.when(mine, F.col("kind"))).alias(f"{name}_kind"))
    # Dealt out first: an aggregate before the shuffle would sort all leaves of a task and has nothing to merge.
    return rows.repartition(*keys, "path").groupBy(*keys, "path").agg(*picks)


def _moved(a: str, b: str) -> Column:
    return ~(F.col(a).eqNullSafe(F.col(b)) & F.col(f"{a}_kind").eqNullSafe(F.col(f"{b}_kind")))


def manifest_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Paths whose leaf or its kind differs; inputs are rows of ``leaves``."""
    both = _sides({"old": before, "new": after}, keys)
    return both.filter(_moved("old", "new")).select(*keys, "path", "old", "new", "old_kind", "new_kind")


def three_way_diff(last_applied: DataFrame, live: DataFrame, desired: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per path: drift (live moved), change (desired moved) or conflict (both, differently)."""
    rows = _sides({"last_applied": last_applied, "live": live, "desired": desired}, keys)
    drifted, wanted = _moved("last_applied", "live"), _moved("last_applied", "desired")
    outcome = F.when(drifted & wanted, F.when(_moved("live", "desired"), "conflict").otherwise("converged")) \
        .when(drifted, "drift").when(wanted, "change")
    return rows.withColumn("outcome", outcome).filter("outcome IS NOT NULL").select(
        *keys, "path", "last_applied", "live", "desired", "outcome")


def diff_summary(diffs: DataFrame, keys: Sequence[str], kind: Column, name: Column) -> DataFrame:
    """One sentence per change: ``kind name: path old → new; …`` with the paths in order."""
    step = F.concat("path", F.lit(" "), F.coalesce("old", F.lit("∅")), F.lit(" → "), F.coalesce("new", F.lit("∅")))
    # The changed paths of one document; bounded by its size.
    parts = diffs.select(*keys, kind.alias("_kind"), name.alias("_name"), "path", step.alias("_step"))
    listed = parts.groupBy(*keys, "_kind", "_name").agg(
        F.sort_array(F.collect_list(F.struct("path", "_step"))).alias("_steps"))
    text = F.concat("_kind", F.lit(" "), "_name", F.lit(": "), F.array_join(F.transform("_steps", lambda s: s["_step"]), "; "))
    return listed.select(*keys, text.alias("diff_summary"))
