"""Streaming forms of the batch operators.

Every job takes and returns streaming frames; where they come from and go to is
the caller's choice (Kafka in production, files here).  Delivery is at least once:
writers are keyed by batch id, and duplicates fall to the deduplication key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from faultlens.functions.columns import SECOND, from_micros, micros
from faultlens.operators import alerts as al
from faultlens.operators import correlate as cr
from faultlens.operators import templates as tm
from faultlens.session import materialise, run_dir
from faultlens.sources.manifest import MergedTable
from faultlens.sources.records import read_alert_payloads
from faultlens.sources.sinks import signal_records
from faultlens.streaming.counters import Counters

WATERMARK = "10 minutes"
ALERT_COUNTERS = "alerts"  #: name under which the counters of the alert stream are observed


def read_files(spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None,
               per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def run_to_files(stream: DataFrame, label: str, path: str | None = None, mode: str = "append", counters: Counters | None = None) -> str:
    """Process what is there now, write it as files and stop; returns the folder.

    ``counters`` takes what the stream observes.
    """
    spark = stream.sparkSession
    base = path or run_dir(spark, label)
    query = (
        stream.writeStream.format("parquet").outputMode(mode).trigger(availableNow=True)
        .option("checkpointLocation", f"{base}/checkpoint").start(f"{base}/data")
    )
    while counters is not None and not query.awaitTermination(10):
        counters.take(query)
    query.awaitTermination()
    if counters is not None:
        counters.take(query)
    return f"{base}/data"


END = "timestamp'2250-01-01 00:00:00'"  #: event time of the row that ends bounded input; pandas holds times until 2262


def run_bounded(build: Callable[[DataFrame], DataFrame], stream: DataFrame, ts: str, label: str) -> str:
    """Process bounded input to its very end; returns the folder of what ``build`` makes of it.

    Once all input is read, one more row arrives, empty but for a time far ahead.  It
    moves the watermark past every window, session and timer that the input has
    opened, so these are emitted as well; its own window never closes.
    """
    spark = stream.sparkSession
    base = run_dir(spark, label)
    marks = spark.createDataFrame([], stream.schema)
    marks.write.parquet(f"{base}/marks")
    marked = build(stream.unionByName(read_files(spark, f"{base}/marks", stream.schema)))
    run_to_files(marked, label, base)
    last = [F.expr(END).cast(f.dataType).alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
    spark.range(1).select(*last).write.mode("append").parquet(f"{base}/marks")
    return run_to_files(marked, label, base)


def run_to_kafka(records: DataFrame, options: dict[str, str], topic: str, checkpoint: str, producer: dict[str, str]) -> StreamingQuery:
    """Keyed records to a topic; the caller keeps the query running."""
    return (
        records.writeStream.format("kafka").options(**options, **producer).option("topic", topic)
        .option("checkpointLocation", checkpoint).start()
    )


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], label: str, path: str | None = None) -> None:
    base = path or run_dir(stream.sparkSession, label)
    query = (
        stream.writeStream.foreachBatch(each).trigger(availableNow=True)
        .option("checkpointLocation", f"{base}/checkpoint").start()
    )
    query.awaitTermination()


def stream_alerts(texts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Alert payload texts to keyed signal records: stateless and without shuffle.

    What becomes of the alerts is observed as ``ALERT_COUNTERS``; what the topic refuses
    (``sinks.publishable``) is for the writer to count.
    """
    good, _ = read_alert_payloads(texts)
    alerts = al.explode_alerts(good)
    return signal_records(al.alerts_to_signals(alerts.observe(ALERT_COUNTERS, *al.counter_columns()), as_of))


def windowed_edges(requests: DataFrame, ts: str = "ts", window: str = "30 seconds") -> DataFrame:
    """Request rate per edge in tumbling windows."""
    seconds = F.unix_timestamp(F.col("w.end")) - F.unix_timestamp(F.col("w.start"))
    return (
        requests.withWatermark(ts, WATERMARK).groupBy(F.window(ts, window).alias("w"), "src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "src", "dst", (F.col("n") / seconds).alias("weight"))
    )


def sliding_counts(rows: DataFrame, keys: Sequence[str], ts: str = "ts", length: str = "5 minutes",
                   slide: str | None = None) -> DataFrame:
    """Counts per key in windows of ``length``; overlapping ones if ``slide`` is shorter."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    return (
        rows.withWatermark(ts, WATERMARK).groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    )


def dedupe_stream(signals: DataFrame) -> DataFrame:
    """First signal per (fingerprint, start, resolved or not) while the watermark remembers it."""
    keyed = signals.withColumn("_closed", F.col("ts_resolved").isNotNull())
    return keyed.withWatermark("ts_detected", WATERMARK).dropDuplicatesWithinWatermark(
        ["fingerprint", "ts_started", "_closed"]).drop("_closed")


def correlate_streams(anomalies: DataFrame, candidates: DataFrame, keys: Sequence[tuple[str, str]],
                      before_us: int = cr.BEFORE_US, after_us: int = cr.AFTER_US) -> DataFrame:
    """Anomalies with the candidates of their window; unmatched ones follow once it has passed.

    anomalies carry ``a_ts``, candidates ``c_ts``; the keys limit a window to one subject.
    """
    left = anomalies.withWatermark("a_ts", WATERMARK)
    right = candidates.withWatermark("c_ts", WATERMARK)
    on = (F.col("c_ts") >= F.col("a_ts") - F.expr(f"INTERVAL {before_us // SECOND} SECONDS")) & (
        F.col("c_ts") <= F.col("a_ts") + F.expr(f"INTERVAL {after_us // SECOND} SECONDS"))
    for a, b in keys:
        on = on & (F.col(a) == F.col(b))
    return left.join(right, on, "leftOuter")


def episode_sessions(signals: DataFrame, keys: Sequence[str], ts: str = "ts", gap: str = "1 hour") -> DataFrame:
    """Emissions of one key no further apart than the gap form an episode."""
    return (
        signals.withWatermark(ts, WATERMARK).groupBy(F.session_window(ts, gap).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n_emissions"))
        .select(*keys, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n_emissions")
    )


class LateRows:
    """``foreachBatch`` writer that sends rows behind the watermark to dead letters.

    The watermark of a batch is the newest time of all earlier batches minus the
    delay.  The newest time of each batch is stored under its id, so a batch that
    runs again sees the same watermark and overwrites its own output.
    """

    def __init__(self, spark: SparkSession, base: str, ts: str, delay_s: int = 600):
        self.spark, self.base, self.ts, self.delay_s = spark, base, ts, delay_s

    def watermark(self, batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        seen = self.spark.read.schema("newest long, batch long").parquet(f"{self.base}/seen")
        newest = seen.filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        return None if newest is None else newest - self.delay_s * SECOND

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        mark = self.watermark(batch_id)
        late = F.lit(False) if mark is None else F.coalesce(F.col(self.ts) < from_micros(F.lit(mark)), F.lit(False))
        newest = Observation()
        marked = rows.observe(newest, F.max(micros(F.col(self.ts))).alias("newest")).withColumn("late", late)
        marked.write.mode("overwrite").partitionBy("late").parquet(f"{self.base}/rows/batch={batch_id}")
        seen = self.spark.createDataFrame([(newest.get["newest"],)], "newest long")
        seen.write.mode("overwrite").parquet(f"{self.base}/seen/batch={batch_id}")

    def split(self) -> tuple[DataFrame, DataFrame]:
        """(rows in time, late rows with their reason)."""
        rows = self.spark.read.parquet(f"{self.base}/rows").withColumn("late", F.col("late").cast("boolean"))
        return rows.filter("not late").drop("late"), rows.filter("late").drop("late").withColumn("reason", F.lit("late"))


class TemplateTable:
    """``foreachBatch`` writer that keeps the distinct masked lines of all batches, merged level by level.

    Templates are derived from the merged lines when asked for, so they equal those
    of one batch run over everything, whatever the split into micro-batches.
    """

    def __init__(self, spark: SparkSession, base: str, fan: int = 8):
        self.lines = MergedTable(spark, f"{base}/lines", tm.merge_lines, fan)

    def __call__(self, logs: DataFrame, batch_id: int) -> None:
        self.lines.add(tm.distinct_lines(logs), batch_id)

    def templates(self, max_words: int = tm.MAX_WORDS) -> DataFrame:
        return tm.fold_templates(tm.with_templates(materialise(tm.merge_lines(self.lines.rows()), "lines"), max_words))


def replay(spark: SparkSession, folder: str, ts: str, start: Column, transform: Callable[[DataFrame], DataFrame],
           key: Sequence[str]) -> DataFrame:
    """Run a transform again over the retained input from ``start`` on; same keys, no doubles."""
    rows = spark.read.parquet(folder).filter(F.col(ts).cast("timestamp") >= start)
    return transform(rows).dropDuplicates(list(key))
