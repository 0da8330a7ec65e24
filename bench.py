"""Times the headline queries on local cores and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from catalog import QUERIES
from ledgerspark.session import local_session

HEADLINE = [
    "installment_summary", "assign_invoice", "item_summary", "products_and_gifts",
    "credit_details", "concept_balances", "goal_metrics", "seller_status", "normalize_text",
    "validate_phone", "dedupe_first", "dup_flag", "payments_received", "apply_payment",
    "collections_bank", "collections_cash", "classify_advance", "monthly_base", "bureau_a",
    "bureau_b",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    spark.sparkContext.setLogLevel("OFF")
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
