"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then RUNS times; its best time counts. Results go
to a sink that discards rows, so the time is Spark's and not that of the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from storelens import catalog  # noqa: E402
from storelens.session import local_session  # noqa: E402

RUNS = 2
HEADLINE = [
    "v1_sale_summary",
    "v2_tender_summary",
    "s3_tender_rollup",
    "v5_cost_velocity",
    "v6_quarterly_sales",
    "m1_average_sales_customer_store",
    "m3_monthly_average_sales_customer_store",
    "m5_monthly_transactions_customer_store",
    "m4b_weekday_transactions",
    "m6b_channel_sales_share",
    "m10_monthly_tender_transactions_customer_store",
    "m12_share_of_card_spend",
    "m23_house_card_use",
    "m24_segment_share",
    "m29_monthly_tender_by_period",
    "m9b_active_customers",
    "m13_acquisition_rate",
    "m16_longevity",
    "mc_comparable_sales",
    "mi2_stock_out_share",
    "mi5_return_on_inventory",
    "mi6_lot_listing",
    "q1_sale_key_violations",
    "q3_foreign_key_violations",
    "x1_reachability_matrix",
]


def seconds(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    catalog.run(name, spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    times = {}
    for name in HEADLINE:
        seconds(spark, folder, name)
        times[name] = round(min(seconds(spark, folder, name) for _ in range(RUNS)), 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
