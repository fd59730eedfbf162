import random
import json
import pytest
from pyspark.sql import functions as F

from faultlens.functions import text as tx
from faultlens.operators import changes as ch
from faultlens.operators import feedback as fb
from faultlens.operators import logs as lg
from faultlens.operators import templates as tm


@pytest.mark.parametrize(("line", "masked"), [
    ("mail a.b+c@example.co.in now", "mail <EMAIL> now"),
    ("call +91 9876543210", "call <PHONE>"),
    ("call +919876543210", "call <PHONE>"),
    ("call 9876543210,9876543211", "call <PHONE>,<PHONE>"),
    ("pan ABCDE1234F", "pan <PAN>"),
    ("id 123456789012", "id <AADHAAR>"),
    ("cvv: 123", "cvv: ***"),
    ("CVV2 = 1234", "CVV2 = ***"),
    ("ref 1234567890123", "ref 1234567890123"),
])
def test_masks(spark, line, masked):
    df = spark.createDataFrame([(line,)], "t string").select("t", tx.mask_all(F.col("t")).alias("m"))
    assert df.first()["m"] == masked
    assert all(r["left"] == 0 for r in lg.pii_audit(df, "t").collect())


def test_dispatch(spark):
    stack = 'Exception in thread "main" java.lang.IllegalStateException: x\n\tat a.B.c(B.java:1)\n\tat a.B.d(B.java:2)'
    rows = [
        ("linkerd-proxy-a", 'level=warn msg="a \\"b\\" c" k=1 k=2'),
        ("haproxy-a", '10.0.1.2:33317 [06/Feb/2009:12:14:14.655] http-in static/srv1 10/0/30/69/109 200 2750 - - ---- 1/1/1/1/0 0/0 {1wt.eu} {} "GET /index.html HTTP/1.1"'),
        ("app-a", '{"message":"m","n":{"x":1}}'),
        ("java-a", stack),
        ("app-b", "plain"),
        ("app-c", '{"broken":'),
    ]
    good, bad = lg.dispatch_parse(spark.createDataFrame(rows, "source_topic string, value string"))
    got = {r["source_topic"]: r["fields"] for r in good.collect()}
    assert got["linkerd-proxy-a"] == {"level": "warn", "msg": 'a "b" c', "k": "2"}
    assert got["haproxy-a"]["status"] == "200" and got["haproxy-a"]["path"] == "/index.html"
    assert got["app-a"] == {"message": "m", "n": '{"x":1}'}
    assert got["java-a"] == {"exception": "java.lang.IllegalStateException", "frames": "2"}
    assert {r["source_topic"] for r in good.filter("format = 'stacktrace'").collect()} == {"java-a"}
    assert {r["source_topic"] for r in bad.collect()} == {"app-b", "app-c"}


def test_templates_do_not_depend_on_order(spark):
    lines = [(f"user u{chr(97 + i % 12)} logged in from 10.0.0.{i}", i) for i in range(60)] + [("disk full on /data", 99)] * 3
    df = spark.createDataFrame([("svc", t, x) for x, t in lines], "service string, t long, line string").withColumn("ts", F.timestamp_seconds("t"))
    want = {("user <*> logged in from <*>", 60), ("disk full on /data", 3)}
    for order in (df.orderBy("t"), df.orderBy(F.desc("t"))):
        assert {(r["template"], r["n"]) for r in tm.mine_templates(order).collect()} == want
    fields = {r["template"]: r["fields"] for r in tm.example_fields(df).collect()}
    assert fields == {"user <*> logged in from <*>": {1: "ua", 5: "10.0.0.0"}}


def test_example_fields_look_at_every_line(spark):
    """The smallest value of a hole may stand on another line than that of the hole beside it, and on none that sorts first."""
    lines = [("a", "from 10 to 9"), ("a", "from 9 to 10"), ("a", " from  11 to 8 "), (None, "from 3 to 4"), (None, "from 2 to 7"), ("a", "from 11 to 8")]
    lines += [("b", f"go {w} id={i}") for i, w in enumerate("zeta eta theta iota kappa lambda mu nu xi pi".split())] + [("b", "go zeta id=x"), ("b", "go zeta id=<*>")]
    logs = spark.createDataFrame(lines, "service string, line string").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    fields = {(r["service"], r["template"]): r["fields"] for r in tm.example_fields(logs).collect()}
    assert fields == {("a", "from <*> to <*>"): {1: "10", 3: "10"}, (None, "from <*> to <*>"): {1: "2", 3: "4"},
                      ("b", "go <*> id=<*>"): {1: "eta", 2: "id=0"}, ("b", "go <*> id=x"): {1: "zeta"}}


def test_three_way(spark):
    def side(**leaves):
        return spark.createDataFrame([(1, p, "number", v) for p, v in leaves.items()], "doc long, path string, kind string, leaf string")

    rows = ch.three_way_diff(side(a="1", b="1", c="1", d="1"), side(a="2", b="1", c="2", d="1"), side(a="3", b="2", c="1", d="1"), ["doc"])
    assert {r["path"]: r["outcome"] for r in rows.collect()} == {"a": "conflict", "b": "change", "c": "drift"}


def test_leaves_and_summary(spark):
    docs = spark.createDataFrame([(1, '{"spec":{"replicas":3,"env":[{"n":"A"},{"n":"B"}]},"x":{}}'), (2, None), (3, "no json")], "doc long, j string")
    after = spark.createDataFrame([(1, '{"spec":{"replicas":2,"env":[{"n":"A"}]},"x":{}}')], "doc long, j string")
    old, new = ch.leaves(docs, ["doc"], "j"), ch.leaves(after, ["doc"], "j")
    assert {(r["doc"], r["path"], r["kind"], r["leaf"]) for r in old.collect()} == {
        (1, "spec.replicas", "number", "3"), (1, "spec.env[0].n", "string", "A"), (1, "spec.env[1].n", "string", "B"), (1, "x", "object", "{}"), (3, "", "text", "no json")}
    diffs = ch.manifest_diff(old.filter("doc = 1"), new, ["doc"])
    text = ch.diff_summary(diffs, ["doc"], F.lit("Deployment"), F.lit("p")).first()["diff_summary"]
    assert text == "Deployment p: spec.env[1].n B → ∅; spec.replicas 3 → 2"


def test_documents_of_any_depth():
    n = 20_000
    ((path, kind, leaf),) = ch.json_leaves('{"a":[' * n + "1.0" + "]}" * n)
    assert (kind, leaf, path.count("a[0]")) == ("number", "1.0", n)
    assert ch.json_leaves("[" * n)[0][1] == "text" and ch.json_leaves("[" * n + "]" * n) == [("[0]" * (n - 1), "array", "[]")]
    rng = random.Random(1)

    def value(depth):
        if depth == 0 or rng.random() < 0.4:
            return rng.choice([1, -2.5, 1e300, 'a"b\\', "é\n", True, None, "", [], {}])
        if rng.random() < 0.5:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        return {rng.choice("ab."): value(depth - 1) for _ in range(rng.randint(0, 3))}

    def outcome(parse, text):
        try:
            return parse(text)
        except ValueError:
            return "no JSON"

    for _ in range(3000):
        text = list(json.dumps(value(4), indent=rng.choice([None, 1])))
        for _ in range(rng.choice([0, 1, 2])):
            i = rng.randrange(len(text) + 1)
            text[i:i + rng.randint(0, 1)] = rng.choice(["", *',}]{["1- x:'])
        text = "".join(text)
        plain = lambda t: json.loads(t, parse_int=ch._Number, parse_float=ch._Number, parse_constant=ch._Number)
        assert outcome(ch._deep, text) == outcome(plain, text), text


def test_leaves_keep_kinds_keys_and_depth():
    assert sorted(ch.json_leaves('{"x":"true","y":"{\\"z\\":1}"}')) == [("x", "string", "true"), ("y", "string", '{"z":1}')]
    assert sorted(ch.json_leaves('{"x":true,"y":{"z":1.50},"n":null}')) == [("n", "null", None), ("x", "boolean", "true"), ("y.z", "number", "1.50")]
    paths = {p for p, _, _ in ch.json_leaves('{"a.b":1,"a":{"b":2,"0":3,"c[0]":4},"d":[5]}')}
    assert paths == {r"a\.b", "a.b", "a.0", r"a.c\[0]", "d[0]"}
    deep = '{"k":' * 500 + "1" + "}" * 500
    assert ch.json_leaves(deep) == [(".".join(["k"] * 500), "number", "1")]


def test_shadow_is_stable(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("fingerprint"))
    once, again = (sorted(r[0] for r in fb.shadow_sample(df).collect()) for _ in range(2))
    assert once == again and 120 < len(once) < 280


def test_lines_without_a_service_get_templates_too(spark):
    words = "alpha beta gamma delta eta theta iota kappa lambda mu nu xi".split()
    logs = spark.createDataFrame([(s, f"user {w} left") for w in words for s in ("a", None)], "service string, line string").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    found = {(r["service"], r["template"]) for r in tm.mine_templates(logs).collect()}
    assert found == {("a", "user <*> left"), (None, "user <*> left")}


def test_pii_audit_looks_closer_only_at_texts_that_may_hold_some(spark):
    """Texts without an @ or three digits in a row hold no kind; a null text counts nothing, no text at all gives no count."""
    texts = ["plain words 12 34", None, "a@b.io", "ABCDE1234F", "123456789012", "+91 1234567890", "cvv 123", "CVV2: 12", "١٢٣"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    maybe = [r[0] for r in df.select(tx.may_hold_pii(F.col("text"))).collect()]
    assert maybe == [False, None, True, True, True, True, True, False, False]
    assert {r["kind"]: (r["hits"], r["left"]) for r in lg.pii_audit(df, "text").collect()} == {k: (1, 0) for k in tx.PII}
    assert {r["hits"] for r in lg.pii_audit(df.where("text IS NULL"), "text").collect()} == {None}
