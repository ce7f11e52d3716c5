"""Benchmark: the whole load, then the reports on the loaded mart. Prints one JSON line."""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from niaga.plans import catalog  # noqa: E402
from niaga.plans.pipeline import run_load  # noqa: E402
from niaga.session import local_session, shared_root  # noqa: E402
from niaga.sources import sample_sources  # noqa: E402

HEADLINE = [
    "a1_monthly_kpi", "a2_category_revenue", "a3_top_products", "a4_status_share",
    "a5_payment_pref", "a6_city_revenue", "b1_tier_segment", "b2_top_customers", "b3_dormant",
    "c1_funnel", "c2_page_latency", "c3_device_split", "c4_conversion", "d1_low_stock",
    "d2_movement_summary", "d3_top_defects", "e1_daily_summary", "e2_category_risk",
    "kpi_summary", "dq_suite", "constraint_fk", "page_sales_daily",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="niaga-bench")
    queries = catalog.queries()
    times: dict[str, float] = {}

    def timed(name, work):
        started = time.perf_counter()
        result = work()
        times[name] = round(time.perf_counter() - started, 3)
        return result

    root = f"{shared_root(spark)}/niaga/{spark.sparkContext.applicationId}/bench"

    def load(to: str):
        return run_load(
            spark,
            sample_sources(spark, sf_dir),
            f"{root}/{to}",
            catalog.SNAPSHOT,
            publish_failed_checks=True,
        )

    timed("load_first", lambda: load("first"))  # includes JVM warm-up
    loaded = timed("load", lambda: load("second"))
    rows = sum(m["rows"] for name, m in loaded.metrics.items() if name.startswith("stg_"))
    catalog.use_mart(spark, sf_dir, loaded.mart)
    for name in HEADLINE:
        timed(name, lambda name=name: queries[name](spark, sf_dir).collect())

    total = sum(times.values())
    print(
        json.dumps(
            {
                "metric": "first and second full load and 22 report queries, total wall time",
                "value": round(total, 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "source_rows": rows,
                "load_rows_per_sec": round(rows / times["load"]),
                "at": dt.datetime.now(dt.UTC).isoformat(timespec="seconds"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
