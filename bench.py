"""Benchmark: full warehouse build and the business reports B1-B12.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line.  Each measurement is the median of
$BENCH_REPEATS runs after one warm-up run.

* build: six tables built from the source views and written as Parquet
  (transform + load of the warehouse).
* b1..b12: each report read from the written warehouse and collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from starforge.plans import cohort, reports  # noqa: E402
from starforge.plans.pipeline import TABLE_ORDER, build, write  # noqa: E402
from starforge.rules import FIXTURE_RULES  # noqa: E402
from starforge.session import get_session  # noqa: E402
from starforge.sources.fixtures import load_fixture_sources  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def timed(fn) -> float:
    t = time.perf_counter()
    fn()
    return time.perf_counter() - t


def median_time(fn) -> float:
    fn()                                    # warm-up
    return statistics.median(timed(fn) for _ in range(REPEATS))


def main() -> None:
    spark = get_session(master=f"local[{CPUS}]", shuffle_partitions=max(8, 2 * CPUS),
                        app_name="starforge-bench",
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
                               # partitions sized to the data: at sf0.1 a whole
                               # shuffle is a few MB, the 64 MB default would
                               # put it in one task
                               "spark.sql.adaptive.advisoryPartitionSizeInBytes":
                                   os.environ.get("BENCH_ADVISORY_PARTITION", "2m")})
    root = tempfile.mkdtemp(prefix="starforge-bench-")
    runs = {"n": 0}

    def do_build():
        runs["n"] += 1
        src = load_fixture_sources(spark, SF_DIR)
        write(build(spark, src, FIXTURE_RULES), f"{root}/wh{runs['n']}")

    results = {"build": median_time(do_build)}
    wh = f"{root}/wh{runs['n']}"
    t = {name: spark.read.parquet(f"{wh}/{name}") for name in TABLE_ORDER}
    src = load_fixture_sources(spark, SF_DIR)
    f, c, d, p, r = (t["fact_orders"], t["dim_customers"], t["dim_date"], t["dim_products"],
                     t["fact_cohort_retention"])
    report_q = {
        "b1": lambda: reports.top_customers_by_revenue(f, c),
        "b2": lambda: reports.monthly_revenue(f, d),
        "b3": lambda: reports.retention_since(r, "1999-01-01"),
        "b4": lambda: reports.category_segment_performance(f, p),
        "b5": lambda: reports.revenue_metrics(f),
        "b6": lambda: reports.delivery_performance(f),
        "b7": lambda: reports.status_counts(f),
        "b8": lambda: reports.build_metrics(reports.fanout_weights(f, src.reviews)),
        "b9": lambda: reports.clv_stats(c),
        "b10": lambda: reports.calendar_summary(d),
        "b11": lambda: cohort.cohort_insights(r),
        "b12": lambda: reports.fk_null_coverage(f),
    }
    for name, q in report_q.items():
        results[name] = median_time(lambda q=q: q().collect())
    total = sum(results.values())
    print(json.dumps({"metric": "build_plus_reports_sec", "value": round(total, 3),
                      "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in results.items()},
                      "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
                      "cpus": CPUS, "repeats": REPEATS,
                      "rows": {"fact_orders": f.count(), "dim_customers": c.count()}}))
    spark.stop()


if __name__ == "__main__":
    main()
