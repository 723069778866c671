"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names instead of the headline set; "all" for every query
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barlake.plans.queries import QUERIES  # noqa: E402
from barlake.session import build_session  # noqa: E402

HEADLINE = [
    "scan_bars",
    "market_features",
    "market_features_wide",
    "market_features_by_supplier",
    "single_series_features",
    "tick_sma",
    "f_ema",
    "hybrid_dataset",
    "pressure_buckets",
    "event_study",
    "trajectory_around",
    "cross_correlation",
    "feature_correlation",
    "roc_auc",
    "roc_curve",
    "raw_contract_lines",
    "contract_violations",
    "feature_contract",
    "chrono_split",
    "tick_split",
    "feature_upsert",
    "drift_wasserstein",
    "drift_ks",
    "score_fixed_coeff",
    "evaluate_model",
    "shap_importance",
]


def run(spark, sf_dir: str, name: str) -> float:
    """Seconds to plan the query and compute every row and column of its result."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        int(cpus),
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, sf_dir, "scan_bars")  # JVM and file system warm-up
    seconds = {name: round(run(spark, sf_dir, name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
