"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 1).
Each query runs once to warm up, then BENCH_RUNS times; the median counts. Every row is produced
(noop sink), nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellweft.queries import QUERIES
from cellweft.session import build_session

HEADLINES = [
    "agg_01_token_counts", "agg_02_label_table", "agg_04_label_summary", "agg_05_thresholds", "agg_06_describe",
    "agg_07_running_stats", "agg_08_histogram_20", "agg_09_box_stats", "agg_16_binary_scores", "agg_17_roc_auc",
    "agg_20_ari_nmi_by_file", "win_01_boost_picks", "win_02_first_per_key", "win_04_stratified_split",
    "ml_01_training_rows", "ml_03_boosted_labels", "ml_04_drop_unpaired", "join_01_merge_predictions", "join_03_context",
    "join_04_prob_intensity", "tr_01_boxcox_fit", "tr_01_boxcox_profile", "tr_03_gating_fit", "tr_07_robust_scale",
    "rep_06_spatial", "ml_18_logistic_curves",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session("bench", cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for i in range(runs + 1):
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                times.append(time.time() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
