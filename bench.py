"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import time

from bazaarlake.plans.catalogue import QUERIES
from bazaarlake.session import build_session

HEADLINE = [
    "bronze_parse_events", "payments_clean", "payments_dedup_latest", "payments_validity_split", "user_rolling_30d",
    "user_distinct_30d", "velocity_5min_1h", "silver_payments", "session_gap_30m", "silver_sessions",
    "pseudonymise_crm", "mask_free_text", "dim_customers_rfm", "fact_orders", "kpi_daily", "feature_store",
    "dq_payments_suite", "rule_score", "upsert_latest", "carrier_kpis", "funnel_steps", "bi_top10", "kyc_extract",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total of best of two runs", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
