"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set input
and cores. A query is timed from building its plan to its last row."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "U2_normalize_url", "U5_clean_url", "H1_html_text", "H7_link_scores", "P7_candidates",
    "P8_cap_identical", "L1_request_slots", "L7_reconcile", "A2_consolidate", "A3_sources",
    "W2_contact_rank", "K2_top_eligible", "W6_duplicate_counts", "D1_row_outcomes", "R2_summary",
    "R3_final_contacts", "R6_domain_summary", "A13_failure_rollup", "contacts_from_texts",
]


def main() -> None:
    from pyspark.sql import SparkSession

    cpus = os.environ.get("BENCH_CPUS", "8")
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="callsheet-bench-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from callsheet.plans import catalog

    took = {}
    for name in HEADLINE:
        best = None
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            started = time.time()
            catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            spent = time.time() - started
            best = spent if best is None else min(best, spent)
        took[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
                      "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
