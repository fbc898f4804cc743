"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a01_response_summary_rollups", "j01_bracketing_asof", "j05_interval_overlap_audit", "j06_presence_counts", "d01_keep_last", "d04_prioritised_dedup_rules",
    "w02_interval_merge", "w05_quiet_window_mining", "l04_candidate_labelling", "a08_epoch_coverage", "a15_bias_calibration", "a20_sigma_coverage",
    "t01_ols_slopes", "t05_ks_statistic", "t08_sigma_calibration", "v02_period_mean", "v09_benjamini_hochberg", "s04_sessioned_ranging_ingest",
]


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    from orrery.plans import load_all
    from orrery.plans.registry import QUERIES
    from orrery.session import build_session

    load_all()
    spark = build_session(f"local[{cpus}]", "bench", partitions=int(cpus) if cpus.isdigit() else 8, memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{d}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    timings = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, d).write.format("noop").mode("overwrite").save()
        timings[n] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": os.path.basename(d.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
