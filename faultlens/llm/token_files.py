"""Token files: the ids of all documents in doc_id order, in blocks of the range coder.

A file is one Parquet part written by Spark's committer, so a retried task leaves no half
file.  Its rows are blocks (part, block, docs, ids, payload).  A payload stands by itself:

    length of the document section (uint32), that section, one coded block of ids

The document section is zlib-compressed: number of documents (uint64), their ids (int64),
marks of null ids (one byte each) and numbers of token ids (uint64), little-endian.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from faultlens.llm import coder
from faultlens.llm.store import pick
from faultlens.llm.tokens import END_ID, closed, crc, tokenizer_path, word_ids

ALPHABET = 49_408  #: ids a block is coded for, or as many as the tokenizer has
BLOCK_IDS = 1 << 20  #: a block is closed by the document that reaches this many ids
BROADCAST_BLOCKS = 1_000_000  #: block starts sent to every executor at most (24 MB)


def pack_block(doc_ids: list, parts: list[np.ndarray], alphabet: int = ALPHABET) -> bytes:
    n = len(doc_ids)
    section = zlib.compress(
        struct.pack("<Q", n) + np.array([d or 0 for d in doc_ids], "<i8").tobytes()
        + bytes(d is None for d in doc_ids) + np.array([len(p) for p in parts], "<u8").tobytes())
    return struct.pack("<I", len(section)) + section + coder.encode(np.concatenate(parts), alphabet)


def unpack_block(payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc ids, numbers of ids, ids)."""
    size, = struct.unpack_from("<I", payload)
    section = zlib.decompress(payload[4:4 + size])
    n, = struct.unpack_from("<Q", section)
    docs = np.frombuffer(section, "<i8", n, 8).tolist()
    null = section[8 + 8 * n:8 + 9 * n]
    counts = np.frombuffer(section, "<u8", n, 8 + 9 * n).astype(np.int64)
    return [None if gone else d for d, gone in zip(docs, null)], counts, coder.decode(payload[4 + size:])


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write the ids of every row, with the end id, in ascending order of doc_id.

    Null ids come first, equal ids in the order of their text's hash.  Null and empty texts
    are the end id alone.  No rows give no blocks.
    """
    source = tokenizer or tokenizer_path()
    text = F.col("text").cast("string")
    plain = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = plain.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h")

    def run(batches):
        from pyspark import TaskContext

        part, block, names, held, total = TaskContext.get().partitionId(), 0, [], [], 0

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(names)], pa.int64()), pa.array([total], pa.int64()),
                 pa.array([pack_block(names, held, max(ALPHABET, word_ids(source).size, end_id + 1))], pa.binary())], ["part", "block", "docs", "ids", "payload"])

        for batch in batches:
            doc = batch.column(0).to_pylist()
            for lo, ids, bounds in word_ids(source).encode(batch.column(1)):
                for k, x in enumerate(closed(ids, bounds, end_id)):
                    names.append(doc[lo + k])
                    held.append(x)
                    total += len(x)
                    if total >= BLOCK_IDS:
                        yield row()
                        block, names, held, total = block + 1, [], [], 0
        if names:
            yield row()

    coded = ordered.select("doc_id", "text").mapInArrow(run, "part int, block int, docs long, ids long, payload binary")
    coded.write.option("compression", "uncompressed").parquet(path)


def block_starts(files: DataFrame) -> DataFrame:
    """(part, block, before): the number of ids before each block, from part totals and order within a part."""
    index = files.select("part", "block", "ids")
    totals = index.groupBy("part").agg(F.sum("ids").alias("ids"))  # one row a file
    before = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = totals.select("part", before.alias("base"))
    inside = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return index.select("part", "block", inside.alias("inside")).join(base, "part").select("part", "block", (F.col("base") + F.col("inside")).alias("before"))


def read_tokens(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document; with ``digest`` ids_crc32 stands for the ids."""
    files = spark.read.parquet(path)
    starts = block_starts(files)
    small = files.select("part").count() <= BROADCAST_BLOCKS
    joined = files.select("part", "block", "payload").join(F.broadcast(starts) if small else starts, ["part", "block"])
    last = pa.int64() if digest else pa.list_(pa.int32())

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                docs, counts, ids = unpack_block(batch.column(2)[k].as_py())
                ends = np.cumsum(counts)
                begins = ends - counts
                out = [crc(ids[a:b]) if digest else ids[a:b].astype(np.int32) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(begins + batch.column(3)[k].as_py()), pa.array(counts), pa.array(out, last)],
                    ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    kind = "ids_crc32 long" if digest else "ids array<int>"
    return joined.select("part", "block", "payload", "before").mapInArrow(run, f"doc_id long, start long, n_tokens long, {kind}")
