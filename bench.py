"""Headline-query timings at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query seconds), "unit",
"queries": {name: seconds}, "sf", "cold_queries"}.  Each query is run to
completion with a no-op sink (``write.format("noop")``), so the whole plan
executes without collecting to the driver.  Every query runs $BENCH_RUNS times
(three by default) from a clean state (shared models rebuilt, cache cleared);
"queries" reports the median and "cold_queries" the first run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from portalforge.queries import QUERIES, reset_models  # noqa: E402
from portalforge.session import build_session  # noqa: E402

HEADLINE = (
    "cnv_gene_copy", "cnv_matrix", "cnv_discrete", "merged_segments",
    "sample_registry", "sample_sheet", "patient_sheet", "center_map", "file_manifest",
    "transfer_plan", "expression_long", "expression_zscore", "merged_maf",
    "fusion_table", "sv_table", "case_lists",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    os.environ.setdefault("SPARK_DRIVER_MEMORY", "16g")  # local mode: the one JVM of this run
    spark = build_session(master=f"local[{cpus}]", app="portalforge-bench",
                          shuffle_partitions=int(os.environ.get("SHUFFLE_PARTITIONS", cpus)))
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM start and first-scan costs are not a query's time
    QUERIES["cnv_length_counters"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, cold = {}, {}
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    for name in names:
        taken = []
        for _ in range(max(runs, 1)):
            # no reuse between runs: shared models (registry, sheets, file
            # manifest) are rebuilt inside the query that needs them
            reset_models()
            spark.catalog.clearCache()
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - t0)
        cold[name], times[name] = round(taken[0], 3), round(median(taken), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cold_queries": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
