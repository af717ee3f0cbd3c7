"""Headline query timings: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Each query is forced with the ``noop`` sink (full computation, nothing
collected to the driver).  The feature table is built by the first query and
reused by later ones as a written table, as a pipeline run would.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feature_table", "user_profile", "dataset_overview", "segment_summary", "threshold_sweep",
    "roc_auc", "stratified_split", "knn_topk", "knn_score_exclude_self", "silhouette",
    "davies_bouldin", "candidate_pairs", "unseen_candidates", "topn_per_user", "corr_matrix",
    "keyword_flags", "emotion_score", "k_metrics", "rf_ranker", "recommendations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from shoplens.plans.catalog import REGISTRY
    from shoplens.session import local_session

    spark = local_session(cpus, shuffle_partitions=2 * cpus)
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf_text = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf: float | str = float(sf_text)
    except ValueError:
        sf = sf_text
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
