"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from keepwell.queries import QUERIES
from keepwell.session import local_session

# Whole pipelines first; the rest reads what they stored.
HEADLINES = (
    "executive_kpis",
    "silver_transactions_unified",
    "silver_customer_identity",
    "gold_customer_360_n",
    "gold_customer_360_p",
    "churn_features_n",
    "churn_features_p",
    "churn_scores_n",
    "churn_scores_p",
    "next_best_actions_n",
    "next_best_actions_p",
    "dq_expectation_report",
    "cdc_snapshot_diff",
    "sync_upsert_merge",
    "kpi_overall",
    "risk_band_distribution",
    "serve_customer_search",
    "serve_customer_detail",
    "profile_features",
    "feature_correlations",
    "feature_quantiles_by_label",
    "stratified_split",
    "roc_auc_rank",
    "ingest_stream_transactions",
    "ml_train_lr",
    "ml_train_rf",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINES
    # one unmeasured run, so that the first query does not pay for the start of the JVM
    QUERIES[wanted[0]](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
