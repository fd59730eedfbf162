"""Spelling variants: words one edit apart, found by sorting the rotations of marked words.

A word is marked with a terminator and turned so that each of its characters comes last in
one rotation.  Words that differ in one character have rotations that agree up to that last
character; a word that lacks it has one that ends right there.  So the words one edit apart
lie together once rotations are sorted by what comes before the last character: in a range no
longer than the alphabet.  One scan of each range finds a word's neighbours there and the
commonest of them.  A word takes its commonest neighbour as its form if that is common enough.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from faultlens.llm import textops as T
from faultlens.llm.store import Tables, pick

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LETTERS, OCCURRENCES, RATIO = 5, 3, 2  #: code points and occurrences a word needs; how many times commoner its form is
END = "\0"  #: terminator, which no word holds
HELD = 100_000  #: words a task counts before it hands them on
LONG = 64  #: words of more code points are turned by hashes of their two parts, not letter by letter


def _fold(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.encode().lower().decode()


def word_counts(docs: DataFrame, change: Callable | None = None, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n) of the words of all texts with enough letters and occurrences.

    Words are runs of letters, A-Z in lower case.  ``change`` makes of a doc_id a function that
    is applied to each word of its text.  A null text has no words; rows stand for themselves.
    """
    def run(batches):
        T.hold()
        total: Counter = Counter()

        def out():
            rows = pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return rows

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = Counter(RUN.findall(_fold(text.as_py() or "")))
                make = change(doc_id) if change else None
                for word, n in found.items():
                    if make:
                        word = make(word)
                    if len(word) >= letters:
                        total[word] += n
                if len(total) >= HELD:
                    yield out()
        yield out()

    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


def _rotations(words: DataFrame) -> DataFrame:
    """(key, last, word, n): each rotation whole (``last`` is empty), and parted into key and last character."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                key, last, at = [], [], []
                part = batch.slice(lo, 500)
                for k, w in enumerate(part.column(0).to_pylist()):
                    turned, n = w + END + w, len(w)
                    key += [turned[i:i + n + 1] for i in range(n + 1)]
                    key += [turned[i + 1:i + n + 1] for i in range(n)]
                    last += [""] * (n + 1)
                    last += w
                    at += [k] * (2 * n + 1)
                rows = part.take(pa.array(at, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(last, pa.string()), *rows.columns], ["key", "last", "word", "n"])

    return words.mapInArrow(run, "key string, last string, word string, n long")


def _range(key: str, rows: list[tuple[str, str, int]], add: Callable) -> None:
    """Tell ``add`` each word's neighbours in one range of rotations: (word, how many, the commonest).

    Replaced characters part the words whose rotations end in a character; the word whose
    rotation is the key itself lacks it.  Of equal characters side by side only the first
    counts as the one to lack, so that no pair is told twice.
    """
    whole = [r for r in rows if not r[0]]
    ended = [r for r in rows if r[0]]
    best = sorted((-n, w) for _, w, n in ended)[:2]
    if len(ended) > 1:
        for _, w, _ in ended:
            add(w, len(ended) - 1, best[1] if best[0][1] == w else best[0])
    for _, short, n in whole:
        before = key[key.index(END) + 1:]
        more = [r for r in ended if not before.endswith(r[0])]
        for _, w, _ in more:
            add(w, 1, (-n, short))
        if more:
            add(short, len(more), min((-m, w) for _, w, m in more))


def _scan(rotations: DataFrame) -> DataFrame:
    """(word, near, rank, best): part sums of a word's neighbours and the commonest of them (rank: its n, negative)."""
    def run(batches):
        held, most = None, {}

        def add(word, near, best):
            now = most.get(word)
            most[word] = (near, best) if now is None else (now[0] + near, min(now[1], best))

        def out():
            rows = [[w, near, *best] for w, (near, best) in most.items()]
            most.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "near", "rank", "best"])

        def settle(table, open_end):
            """Handle the ranges of some sorted rows; return the rows of the last one if it may go on."""
            key = table.column(0)
            same = pc.equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.concatenate([[True], ~same]))
            end = np.append(start[1:], len(key))
            if open_end:
                start, end, rest = start[:-1], end[:-1], table.slice(int(start[-1]))
            many = end - start > 1
            spots = np.flatnonzero(np.repeat(many, end - start))
            rows = table.take(pa.array(spots)).to_pydict()
            at = 0
            for size in (end - start)[many].tolist():
                _range(rows["key"][at], list(zip(*(rows[c][at:at + size] for c in ("last", "word", "n")))), add)
                at += size
            return rest if open_end else None

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                held = settle((pa.concat_tables([held, table]) if held is not None else table).combine_chunks(), True)
                if len(most) >= HELD:
                    yield out()
        if held is not None:
            settle(held.combine_chunks(), False)
        yield out()

    return rotations.repartition("key").sortWithinPartitions("key", "last").mapInArrow(run, "word string, near long, rank long, best string")


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _part_hashes(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first i and of the last n - i characters, for i from 0 to n."""
    codes = T.mix(np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))
    n = len(codes)
    power = T._powers(T._BASE, n + 1)
    head, tail = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
    np.cumsum(codes * power[:n], out=head[1:])
    tail[:n] = np.cumsum(codes[::-1] * power[:n])[::-1]
    size = np.arange(n + 1, dtype=np.uint64) << np.uint64(40)
    return T.mix(head ^ size), T.mix(tail ^ size[::-1])


def _long_pairs(words: DataFrame, tables: Tables) -> DataFrame:
    """(word, near, rank, best) of words with more than LONG code points, whose rotations are kept as hashes of both parts.

    Ranges are as short as for other words; their pairs are checked letter by letter.
    """
    words = tables.keep(words.withColumn("id", F.xxhash64("word")).withColumn("long", F.char_length("word") > LONG))

    def turn(batches):
        for batch in batches:
            for w, id_, long in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist(), batch.column("long").to_pylist()):
                head, tail = _part_hashes(w)
                a, b = (head, tail) if not long else (np.concatenate([head, head[:-1]]), np.concatenate([tail, tail[1:]]))
                for lo in range(0, len(a), 100_000):
                    n = len(a[lo:lo + 100_000])
                    yield pa.RecordBatch.from_arrays([pa.array(T.signed(a[lo:lo + n])), pa.array(T.signed(b[lo:lo + n])), pa.array(np.full(n, id_, np.int64))], ["a", "b", "id"])

    rows = tables.keep(words.mapInArrow(turn, "a long, b long, id long"))
    shared = rows.groupBy("a", "b").agg(F.collect_set("id").alias("ids")).where(F.size("ids") > 1)  # no more than the alphabet and one
    pairs = shared.select(F.explode("ids").alias("u"), "ids").select("u", F.explode("ids").alias("v")).where("u <> v").distinct()
    texts = words.select("id", "word", "n", "long")
    both = pairs.join(texts.toDF("u", "word", "n", "lu"), "u").join(texts.toDF("v", "other", "m", "lv"), "v").where("lu or lv")

    def check(batches):
        for batch in batches:
            ok = [one_edit(x, y) for x, y in zip(batch.column("word").to_pylist(), batch.column("other").to_pylist())]
            yield batch.select(["word", "other", "m"]).filter(pa.array(ok, pa.bool_()))

    near = both.mapInArrow(check, "word string, other string, m long")
    return near.select("word", F.lit(1).cast("long").alias("near"), (-F.col("m")).alias("rank"), F.col("other").alias("best"))


def neighbours(words: DataFrame, tables: Tables) -> DataFrame:
    """(word, n_near, best): how many words are one edit away, and the commonest with its n; (word, n) are distinct words."""
    short = words.where(F.char_length("word") <= LONG)
    part = _scan(_rotations(short))
    if words.where(F.char_length("word") > LONG).limit(1).count():
        part = part.unionByName(_long_pairs(words.where(F.char_length("word") >= LONG), tables))
    return part.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("rank", "best")).alias("best"))


def roots(forms: DataFrame, tables: Tables) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to; each round doubles the steps taken.

    Forms are commoner than their words by a factor, so a chain is short and has an end.
    """
    now = tables.keep(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = tables.keep(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        tables.drop(now)
        now = new
        if not now.where("moved").limit(1).count():
            return now.drop("moved")
        now = now.drop("moved")
        now.stored_at = new.stored_at


def spelling_variants(words: DataFrame, ratio: float = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of (word, n).

    A word's form is the commonest word one edit away, of equally common ones the first in code
    point order, if it occurs ``ratio`` times as often or more (above one); its root is where forms lead to,
    itself if it has none.  Words are distinct and not null; an empty table gives no rows.
    """
    tables = Tables(words.sparkSession, "variants")
    words = tables.keep(words.select("word", "n"))
    found = words.join(neighbours(words, tables), "word", "left")
    common = -F.col("best.rank") >= ratio * F.col("n")
    found = tables.keep(found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("best.best")).alias("form"), F.when(common, -F.col("best.rank")).alias("form_n")))
    last = roots(found.where("form is not null"), tables)
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
