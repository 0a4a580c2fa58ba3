"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs once to warm up the JVM and is then timed as the faster of two
runs, writing its whole result to the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txrisk.operators.features import build_features, feature_table  # noqa: E402
from txrisk.operators.tuning import tune_rounds  # noqa: E402
from txrisk.plans.adapters import raw_transactions, transactions  # noqa: E402
from txrisk.plans.queries import queries  # noqa: E402
from txrisk.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))

HEADLINE = [
    "read_raw_csv",
    "profile_duplicates",
    "profile_numeric",
    "clean_transactions",
    "customer_features",
    "terminal_features",
    "feature_table",
    "rolling_lineitem",
    "union_snapshots",
    "minmax_scaled",
    "class_metrics",
    "roc_auc",
    "ttest_two_arms",
    "daily_drift",
    "messages_json",
    "split_invalid",
    "threshold_curve",
    "ks_drift",
    "compare_models",
]
# Too long to repeat: one run after the others have warmed up the JVM.
ONCE = [
    "gbt_scores",
    "stream_stateless_features",
    "stream_history_features",
    "stream_model_scores",
    "stream_keyed_features",
    "feature_table_in_parts",
    "daily_close",
    "compare_fitted_models",
]


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "txrisk-bench")
    registry = queries()
    seconds: dict[str, float] = {}

    def rolling_features():
        return build_features(transactions(spark, SF_DIR))

    runs = {n: (lambda n=n: registry[n](spark, SF_DIR)) for n in HEADLINE}
    runs["rolling_features"] = rolling_features
    for name, run in runs.items():
        timed(run)
        seconds[name] = min(timed(run), timed(run))
    def two_grid_points():
        """Two points on two folds; the whole grid of 27 takes minutes."""
        rows = feature_table(raw_transactions(spark, SF_DIR))
        return tune_rounds(rows, {"maxDepth": [2, 3], "maxIter": [2]}).table(spark)

    seconds["two_grid_points"] = timed(two_grid_points)
    for name in ONCE:
        seconds[name] = timed(lambda n=name: registry[n](spark, SF_DIR))
    rows = transactions(spark, SF_DIR).count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "stream_tx_per_sec": round(rows / seconds["stream_stateless_features"], 1),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
