"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each
query runs once after one warm-up of the session and is written to a sink
that takes every column, so nothing is pruned away.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tezgah.queries import QUERIES  # noqa: E402
from tezgah.session import local_session  # noqa: E402

HEADLINE = [
    "etl_incremental_sales",
    "load_lookup_current",
    "scd2_product_apply",
    "scd2_customer_apply",
    "kpi_daily_store",
    "kpi_daily_store_pos",
    "inventory_snapshot",
    "campaign_performance",
    "mart_sales_daily",
    "mart_store_kpi_monthly",
    "mart_inventory_alert",
    "mart_category_performance",
    "mart_customer_rfm",
    "kpi_catalog",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    QUERIES["etl_sales_rejects"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = Path(folder).name
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale[2:]) if scale.startswith("sf") else scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
