"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR: one JSON line with the median of the warm runs of each."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from lectern.plans import catalog

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = ("lct_all", "lct_sped", "agg_mv_stats", "agg_scope_summary", "agg_state_progress", "dq_safeguards", "q_lookup_id", "top_n", "agg_enrich_state", "snk_json_nested", "rsh_pivot_sum", "win_row_number", "jn_fallback_chain", "st_fold", "dml_upsert_bell", "tx_page_feat")


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # call sites of columns take half the time that a plan takes to build
        .config("spark.driver.memory", "8g").config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="bench-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    all_queries, took = catalog.queries(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS + 1):  # the first run compiles
            began = time.time()
            all_queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(statistics.median(runs[1:]), 3)
    sf = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, warm, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
