"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of the test tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from faultlens.plans import catalog

HEADLINE = [
    "al12_alerts_to_signals", "al13_alert_counters", "ag1_dedupe_by_fingerprint", "ag7_rollup_signals",
    "ts4_regularise", "ts6_quantile_over_time", "ts7_rolling_zscore", "ts8_rolling_mad", "ts9_burn_rate",
    "dt4_seasonal_decompose", "dt8_score_isolation_forest", "dt11_cooldown", "lg1_dispatch_parse", "lg13_pii_audit",
    "tm2_mine_templates", "jn1_interval_join", "jn7_after_deploy", "gr1_service_edges", "gr2_walk", "chg3_manifest_diff",
    "cr6_rank_causes", "rt1_similar_incidents", "rt3_chunk_documents", "fb7_cost_rollup", "st3_sliding_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("faultlens-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the executors before the clock
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
