"""Leaves of several versions side by side."""

from faultlens.operators.changes import _sides, manifest_diff


def test_leaves_are_not_sorted_before_they_are_dealt_out(spark):
    schema = "doc long, path string, kind string, leaf string"
    old = spark.createDataFrame([(1, "a", "number", "1"), (1, "b", "string", "x"), (None, "c", "null", None)], schema)
    new = spark.createDataFrame([(1, "a", "string", "1"), (1, "b", "string", "x"), (2, "d", "string", "y")], schema)
    plan = _sides({"old": old, "new": new}, ["doc"])._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    below = plan[plan.index("Exchange"):]
    assert "Sort" not in below and "Aggregate" not in below
    got = {(r["doc"], r["path"], r["old"], r["new"], r["old_kind"], r["new_kind"]) for r in manifest_diff(old, new, ["doc"]).collect()}
    assert got == {(1, "a", "1", "1", "number", "string"), (None, "c", None, None, "null", None), (2, "d", None, "y", None, "string")}
