"""Time the headline queries: one warm-up, then the median of the timed runs. Prints one JSON line.

The retail tables are derived and written first, as a shop would store them; the timed queries read the stored tables.

BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS choose the tables, the number of cores and the number of timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillspan.catalog import ON_TABLES, present  # noqa: E402
from tillspan.plans.lineage import run_dir  # noqa: E402
from tillspan.plans.session import local_session  # noqa: E402
from tillspan.sources.star import star_retail  # noqa: E402
from tillspan.sources.tables import Retail, load_tables, with_month, write_table  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = [
    "r01_sales_detail",
    "r02_best_sellers",
    "r03_vip_customers",
    "r04_region_category_revenue",
    "r04b_region_category_rollup",
    "r05_cart_conversion",
    "r06_monthly_trend",
    "r06b_monthly_trend_order_grain",
    "r07_payment_performance",
    "r08_cohort_retention",
    "r08b_cohort_matrix",
    "r09_stockout_forecast",
    "r10_executive_dashboard",
    "v01_product_summary",
    "v02_order_summary",
    "v03_monthly_sales",
    "t01_customer_stats",
    "t02_top_products",
    "t03_daily_revenue",
    "j02_status_orders",
    "j10_merge_items",
    "l04_name_matches",
]


def shuffle_bytes(spark) -> int:
    """Bytes written to shuffles since the session began."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(n).shuffleWriteBytes() for n in range(stages.size()))


STORED = [
    "states", "cities", "categories", "payment_methods", "order_status", "customers", "products", "addresses", "orders",
    "order_items", "reviews", "carts", "coupons",
]


def stored_tables(spark) -> Retail:
    """The tables of a shop read from files; the requests of jobs stay derived."""
    star, directory = star_retail(spark, SF_DIR), run_dir(spark, "bench")
    for name in STORED:
        write_table(with_month(star.order_items, star.orders) if name == "order_items" else getattr(star, name), directory, name)
    loaded = load_tables(spark, directory, STORED)
    return Retail({name: (lambda name=name: getattr(loaded if name in STORED else star, name)) for name in star.names()})


def run(tables: Retail, name: str) -> float:
    start = time.perf_counter()
    present(ON_TABLES[name](tables)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    # Keep the figures of every stage, so that shuffle bytes can be summed over a whole run.
    spark = local_session(CPUS, "bench", shuffle_partitions=int(CPUS), conf={"spark.ui.retainedStages": "1000000"})
    tables = stored_tables(spark)
    wanted = sys.argv[1:] or HEADLINE
    times, shuffled = {}, {}
    for name in wanted:
        run(tables, name)
        before = shuffle_bytes(spark)
        times[name] = round(statistics.median(run(tables, name) for _ in range(RUNS)), 4)
        shuffled[name] = (shuffle_bytes(spark) - before) // RUNS
    print(
        json.dumps(
            {
                "metric": "total of the headline queries on stored tables, median of warm runs",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "runs": RUNS,
                "shuffle_partitions": int(CPUS),
                "shuffle_bytes": shuffled,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
