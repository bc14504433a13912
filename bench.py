"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query is
built and fully computed (written to the ``noop`` sink) after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.catalog import QUERIES
from riskloom.session import local_session

HEADLINE = (
    "active_credit_ratio",
    "application_features",
    "bureau_profile",
    "bureau_balance_profile",
    "previous_profile",
    "installments_profile",
    "pos_cash_profile",
    "credit_card_profile",
    "full_feature_matrix",
    "describe_numeric",
    "pairwise_correlation",
    "embedding_correlations",
    "capped_price_by_flag",
    "histogram_by_class",
    "ordinal_encoding",
    "target_mean_bayes",
    "fold_safe_target_mean",
    "top_mutual_information",
    "evaluation_report",
    "method_comparison",
    "drift_report",
    "monitor_batch_check",
    "fairness_by_attribute",
    "blend_weight_nested",
    "linear_reasons",
    "stream_window_psi",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["category_distribution"](spark, directory).collect()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        begin = time.perf_counter()
        QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    scale = os.path.basename(directory.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
