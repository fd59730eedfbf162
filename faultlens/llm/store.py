"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faultlens.session import run_dir

BROADCAST_ROWS = 300_000  #: rows of a few numbers sent to every executor at most (about 15 MB)


class Tables:
    """Tables written by one run; those no later step reads can be dropped again."""

    def __init__(self, spark, label: str):
        self.spark, self.root, self.n = spark, run_dir(spark, label), 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Write a frame and read it back: lost executors cost nothing, branches share one computation."""
        path = f"{self.root}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stored_at = path
        return out

    def small(self, df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
        """A stored frame of a few numbers a row, to be broadcast if it has at most ``rows`` rows and joined by shuffle beyond."""
        kept = self.keep(df)
        return F.broadcast(kept) if kept.count() <= rows else kept

    def drop(self, *frames: DataFrame) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df.stored_at)
            path.getFileSystem(conf).delete(path, True)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that a caller's other columns cannot clash with its own."""
    return df.select(*[df[n] for n in names])
