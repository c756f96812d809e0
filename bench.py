"""Time the headline queries: full result, no caching between queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

import registry
from carelake.plans.session import discard_written, local_session

HEADLINES = [
    "fraud_summary_by_doctor", "inflated_procedures", "abnormal_rx_quantity", "dispensed_without_rx",
    "duplicate_claims", "hospital_performance", "hospital_capacity", "icu_alerts", "doctor_workload",
    "monthly_visits", "top_diagnoses", "high_risk_patients", "referral_summary", "drug_consumption",
    "low_stock", "expiring_soon", "claims_by_status", "rejection_reasons", "patient_visit_history",
    "patient_prescription_history", "vw_visit_detail", "vw_claim_summary", "vw_inventory_alert",
    "vw_icu_occupancy_rate", "load_visit", "load_claim", "load_prescription_item", "load_visit_procedure",
    "cmd_register_visits", "cmd_dispense", "cmd_submit_claims", "cmd_review_claims",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    queries = registry.queries()
    only = sys.argv[1:]

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    names = only or HEADLINES
    run("monthly_visits")  # start the JVM's compilers and the file system once
    seconds = {name: round(run(name), 3) for name in names}
    discard_written(spark)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
