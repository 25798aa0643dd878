"""Benchmark: run the headline named queries on one data folder, print one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
    BENCH_QUERIES (optional comma list).

Every query is forced to completion with the ``noop`` sink (all rows computed, nothing
collected).  ``prepare`` times building and persisting the enriched campaign table
that the other queries share; each query's time excludes it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mixcast.plans import catalog  # noqa: E402
from mixcast.plans.context import context  # noqa: E402
from mixcast.session import local_session  # noqa: E402

HEADLINE = [
    "campaigns_raw", "enriched_campaigns", "describe", "iqr_outliers", "quasi_constant", "correlation_matrix",
    "histogram", "box_stats", "trend_by_influencer", "saturation_points", "top_roi", "split_stratified",
    "regression_metrics", "classification_metrics", "roc_auc_ovr", "confusion_matrix", "model_comparison",
    "score_scenarios", "scenario_by_model", "sensitivity", "permutation_importance", "shap_linear",
    "lowess_roi", "fit_linear", "shap_kernel", "fit_gbt", "shap_tree",  # each fitted alone, with the whole profile
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else [n for n in HEADLINE if n in catalog.QUERIES]
    spark = local_session(cpus, app="mixcast-bench", extra={"spark.sql.shuffle.partitions": str(int(cpus) * 2)})
    times: dict[str, float] = {}
    t = time.time()
    ctx = context(spark, sf)
    ctx.camp.count()
    times["prepare"] = round(time.time() - t, 3)
    for name in names:
        t = time.time()
        df = catalog.QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf.rstrip("/")), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
