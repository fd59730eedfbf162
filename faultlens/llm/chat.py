"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example: all turns before it as context, its reply as the
only text that is trained on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faultlens.llm.store import pick

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    """Text without any control string: backslashes are doubled, then one goes between < and |."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _role(role: Column) -> Column:
    """A role on one line and without control strings."""
    out = F.replace(role, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("%0A")), F.lit("<"), F.lit("%3C"))


def _unrole(role: Column) -> Column:
    out = F.replace(F.replace(role, F.lit("%3C"), F.lit("<")), F.lit("%0A"), F.lit("\n"))
    return F.replace(out, F.lit("%25"), F.lit("%"))


def expand(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, n_turns, text, loss_start, loss_length), one row per example.

    ``text`` holds the first n_turns turns; the ``loss_length`` characters after the first
    ``loss_start`` are trained on.  Turns are ordered by turn, then role, then text, nulls
    first.  A null role or text counts as empty.  Turns after the last reply, and
    conversations without one, give a last example with nothing to train on, so no turn is
    lost.  Rows with null conv_id form one conversation.  A conversation is one row here,
    as each example repeats all before it.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    head = F.concat(F.lit(START), _role(role), F.lit("\n"))
    turn = F.struct("turn", F.col("role").alias("r"), F.col("text").alias("t"), (role == "assistant").alias("reply"),
                    F.concat(head, escape(text), F.lit(f"{END}\n")).alias("piece"), F.length(head).alias("head"), F.length(escape(text)).alias("chars"))
    rows = pick(conversations, "conv_id", "turn", "role", "text").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")
    cuts = F.filter(F.sequence(F.lit(1), n), lambda k: F.col("turns")[k - 1]["reply"] | (k == n))
    one = rows.select("conv_id", "turns", F.posexplode(cuts).alias("example", "n_turns"))
    last = F.element_at("turns", F.col("n_turns"))
    body = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("n_turns")), lambda x: x["piece"]), "")
    start = F.length("text") - F.length(last["piece"]) + last["head"]
    return one.withColumn("text", body).select(
        "conv_id", "example", "n_turns", "text", F.when(last["reply"], start).otherwise(0).alias("loss_start"),
        F.when(last["reply"], last["chars"]).otherwise(0).alias("loss_length"))


def turns(text: Column) -> Column:
    """The turns of a formatted text as (role, text)."""
    parts = F.split(text, r"<\|im_start\|>")
    parts = F.slice(parts, F.lit(2), F.size(parts))

    def one(part):
        cut = F.locate("\n", part)
        inner = F.substr(part, cut + 1, F.length(part) - cut - F.lit(len(END) + 1))
        return F.struct(_unrole(F.substr(part, F.lit(1), cut - 1)).alias("role"), unescape(inner).alias("text"))

    return F.transform(parts, one)


def loss_text(text: Column, start: Column, length: Column) -> Column:
    return unescape(F.substr(text, start + 1, length))
