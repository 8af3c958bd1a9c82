"""Headline-query timings.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's plan is executed in full with the ``noop`` sink (no driver
collect), after one warm-up query.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    ("cohort_labels", "label_summary"),          # cohort + three labels
    ("notes_tokens", "tokens_in_stay"),          # in-stay notes + tokenizer
    ("hour_sweep", "hour_sweep_population"),     # 21-point sweep, one job
    ("vocabulary", "corpus_vocabulary"),         # vocabulary + doc frequency, all documents
    ("term_freq", "doc_term_freq"),              # per-note term counts
    ("features_33", "feature_combined_33"),      # baseline + comorbidity features
    ("auc", "auc_midrank"),                      # tie-correct ROC area
    ("rebalance", "subsample_7_3"),              # exact split + 7:3 rebalance
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from wardline.plans import registry
    from wardline.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    reg = registry.all_queries()
    reg["latest_stay"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for key, name in HEADLINE:
        t0 = time.time()
        reg[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
